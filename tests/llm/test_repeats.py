import hashlib
import random

import numpy as np
import pyarrow as pa

from ledgerflow.llm import repeats
from ledgerflow.llm.catalog import QUERIES
from ledgerflow.llm.common import table
from ledgerflow.llm.lyndon import Strings, groups, next_smaller, suffix_places
from ledgerflow.llm.repeats import without_repeats

SF = "/root/testdata/sf0.001"


def brute(rows, length=50):
    """(key, bytes, removed, spans, kept) of each row, from the definition."""
    holders = {}
    for key, text in rows:
        raw = (text or "").encode()
        for k in range(len(raw) - length + 1) if key is not None else ():
            w = raw[k : k + length]
            holders[w] = min(holders.get(w, key), key)
    out = []
    for key, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - length + 1) if key is not None else ():
            if holders[raw[k : k + length]] < key:
                gone[k : k + length] = b"\1" * length
        spans = sum(1 for k in range(len(raw)) if gone[k] and (not k or not gone[k - 1]))
        out.append((key, len(raw), sum(gone), spans, bytes(b for b, g in zip(raw, gone) if not g)))
    return sorted(out, key=str)


def found(frame):
    rows = []
    for r in frame.collect():
        spans = list(zip(r["span_starts"], r["span_ends"]))
        rows.append((r["doc_id"], r["n_bytes"], sum(b - a for a, b in spans), len(spans), bytes(r["kept"])))
    return sorted(rows, key=str)


def planted(seed=7):
    rng = random.Random(seed)
    vocabulary = [f"wörd{i}" if i % 9 == 0 else f"w{i * 37}" for i in range(400)]

    def some(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    shared = [some(n) for n in (9, 12, 20, 80)] + ["=" * 300, "ab" * 60, "x" * 49, "y" * 50]
    rows = []
    for key in rng.sample(range(1000), 120):
        parts = [some(rng.randrange(1, 60)) for _ in range(3)] + rng.sample(shared, rng.randrange(0, 4))
        rng.shuffle(parts)
        rows.append((key, " ".join(parts)))
    return rows + [(2000 + i, rows[i][1]) for i in range(20)] + [(3000 + i, rows[i][1][i:-i]) for i in range(1, 20)]


def test_against_brute_force(make):
    rows = planted()
    assert found(without_repeats(make(rows))) == brute(rows)


def test_small_batches_and_hot_names(make):
    rows = planted(8)
    assert found(without_repeats(make(rows), batch_bytes=2000, sort_bytes=3000, hot_contexts=3)) == brute(rows)


def test_query_on_documents(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").collect()]
    wanted = {k: (n, m, s, hashlib.sha256(kept).hexdigest()) for k, n, m, s, kept in brute(rows)}
    got = {r[0]: tuple(r[1:]) for r in QUERIES["op4_repeats"](spark, SF).collect()}
    assert got == wanted


def test_odd_rows(odd, make):
    rows = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    assert found(without_repeats(odd)) == brute(rows)
    assert without_repeats(make([])).collect() == []


def test_suffix_order_is_that_of_bytes():
    rng = random.Random(1)
    for turn in range(150):
        letters = (b"a", b"ab", b"abc ", b"\xf4 \x00z")[turn % 4]
        strings = [bytes(rng.choice(letters) for _ in range(rng.randrange(1, 40))) for _ in range(rng.randrange(1, 12))]
        row, place, position, _ = suffix_places(strings)
        suffixes = [strings[r][p:] for r, p in zip(row.tolist(), place.tolist())]
        assert [suffixes[i] for i in np.argsort(position)] == sorted(suffixes)


def test_lyndon_prefixes():
    strings = [b"banana", b"mississippi", b"aaaa", b"abab"]
    data = Strings(strings)
    following = next_smaller(data)
    for r, s in enumerate(strings):
        for p in range(len(s)):
            smaller = [q for q in range(p + 1, len(s) + 1) if s[q:] < s[p:]]
            assert following[r, p] == min(smaller)
    row = np.repeat(np.arange(4), data.lengths)
    place = np.concatenate([np.arange(n) for n in data.lengths])
    size = following[row, place] - place
    prefixes = [strings[r][p : p + n] for r, p, n in zip(row, place, size)]
    ranks = groups(data, row, place, size)
    assert [sum(x < y for x in prefixes) for y in prefixes] == ranks.tolist()


def test_names_are_found_block_by_block(monkeypatch):
    rng = random.Random(3)
    texts = [bytes(rng.choice(b"abc") for _ in range(n)) for n in (0, 49, 50, 51, 400, 0, 7, 1)] + [b"=" * 300]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0] + [len(t) for t in texts])
    hashes = repeats._gram_hashes
    wanted = []
    for number, begin in enumerate(offsets[:-1].tolist()):
        for first in range(begin, offsets[number + 1] - 49):
            name = min(int(hashes(data[at : at + repeats.GRAM])[0]) for at in range(first, first + 50 - repeats.GRAM + 1))
            if wanted and wanted[-1][0] == name and wanted[-1][3] == number and wanted[-1][2] < repeats.CONTEXT:
                wanted[-1][2] += 1
            else:
                wanted.append([name, first, 1, number])
    for block in (1, 7, 64, 1 << 15):
        sizes = []
        monkeypatch.setattr(repeats, "HASHED", block)
        monkeypatch.setattr(repeats, "_gram_hashes", lambda part: (sizes.append(len(part)), hashes(part))[1])
        found = repeats.named_runs(data, offsets, 50)
        assert [list(r) for r in zip(*(x.tolist() for x in found))] == wanted
        assert max(sizes) <= block + 49  # whatever the text's length


def test_next_smaller_of_strings_of_any_length():
    rng = random.Random(4)
    strings = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(0, 60))) for _ in range(40)] + [b"a" * 70, b"ba" * 30]
    following = next_smaller(Strings(strings))
    for r, s in enumerate(strings):
        assert following[r, : len(s)].tolist() == [min(q for q in range(p + 1, len(s) + 1) if s[q:] < s[p:]) for p in range(len(s))]


def test_runs_come_by_name_batch_and_row():
    rng = np.random.default_rng(6)
    name, owner = rng.integers(0, 40, 500).astype(np.uint64) << np.uint64(58), rng.integers(0, 30, 500)
    batch = rng.integers(0, 4, 30).astype(np.int32)
    order = np.lexsort((owner, batch[owner], name))
    found = repeats._by_name(name, owner, batch)
    assert all((a == b[order]).all() for a, b in zip(found, (name, owner, batch[owner])))
    assert [len(x) for x in repeats._by_name(name[:0], owner[:0], batch)] == [0, 0, 0]


def test_each_string_of_a_context_gets_its_least_key():
    # Two contexts of one name, a third that holds strings of both, one of another name.
    gram, rng = b"", random.Random(9)
    while not gram or repeats._gram_hashes(np.frombuffer(gram, np.uint8))[0] > 1 << 56:
        gram = bytes(rng.randrange(97, 123) for _ in range(repeats.GRAM))
    one, two = b"0" * 31 + gram + b"1" * 31, b"2" * 31 + gram + b"3" * 31
    contexts = [one, two, b"0" * 30 + gram + b"1" * 10, b"4" * 60]
    found = repeats.holders_of(pa.array(contexts, pa.binary()), np.array([5, 6, 2, 9]), 50)
    for context, holders in zip(contexts, found):
        places = range(len(context) - 49)
        wanted = [min(k for c, k in zip(contexts, (5, 6, 2, 9)) if context[p : p + 50] in c) for p in places]
        assert np.broadcast_to(holders, len(wanted)).tolist() == wanted


def test_rows_of_one_key_come_in_one_order_however_they_arrive():
    rows = [(4, "b"), (None, "d"), (4, "a"), (2, "z"), (None, "c"), (4, "c")]
    for turn in range(6):
        ids, bodies = zip(*(rows[turn:] + rows[:turn]))
        docs = repeats._sorted_rows(pa.table({"id": pa.array(ids, pa.int64()), "body": list(bodies)}))
        assert docs.column("body").to_pylist() == ["z", "a", "b", "c", "c", "d"]
