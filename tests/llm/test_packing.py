import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from ledgerflow.llm.catalog import tokenizer_path
from ledgerflow.llm.common import table
from ledgerflow.llm.packing import Encoder, Levels, pack_documents

SF = "/root/testdata/sf0.001"


def check(pieces, docs):
    """Every id of every document in one piece, sequences without gaps."""
    plain = Tokenizer.from_file(tokenizer_path())
    wanted = defaultdict(list)
    for r in docs.collect():
        wanted[r["doc_id"]].append(plain.encode(r["text"] or "", add_special_tokens=False).ids + [2])
    parts, windows = defaultdict(list), defaultdict(list)
    for p in pieces:
        parts[p["doc_id"]].append(p)
        windows[p["sequence_id"]].append((p["offset"], p["length"]))
    assert set(parts) == set(wanted)
    for doc, own in parts.items():
        ids = wanted[doc]
        assert sum(p["length"] for p in own) == sum(map(len, ids))
        for p in own:
            crcs = {zlib.crc32(np.array(i[p["start"] : p["start"] + p["length"]], "<u4").tobytes()) for i in ids}
            assert p["ids_crc32"] in crcs and p["doc_tokens"] in map(len, ids)
    for spans in windows.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 4096
    return sum(4096 - sum(n for _, n in s) for s in windows.values()), len(windows)


def test_round_trip_on_documents(spark):
    docs = table(spark, SF, "documents")
    padding, windows = check(pack_documents(docs, tokenizer_path()).collect(), docs)
    assert padding <= 4096 * docs.rdd.getNumPartitions()


def test_odd_rows(odd):
    check(pack_documents(odd, tokenizer_path()).collect(), odd)


def test_empty_table(make):
    assert pack_documents(make([]), tokenizer_path()).collect() == []


@pytest.mark.parametrize("text", ["<|endoftext|>x don't I'LL", "ΣΑΣ. İx ﬁ ½ '' \x0b\x1c\x85 é é ́x", "A<|ENDOFTEXT|>b", "a  b\n\nc\t d"])
def test_word_by_word_is_the_whole(text):
    encoder = Encoder(tokenizer_path())
    assert np.frombuffer(encoder([text])[0], "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_level_choice_is_the_least_sum_of_squares():
    rng = np.random.default_rng(5)
    levels, number = Levels(40), 0
    for size in rng.integers(1, 40, 600).tolist():
        count = levels.count.copy()

        def cost(level):
            after = count.copy()
            if level:
                after[level] -= 1
            if level + size < 40:
                after[level + size] += 1
            return int((after**2).sum())

        able = [h for h in range(41 - size) if h == 0 or count[h]]
        best = min(cost(h) for h in able)
        chosen = levels.best(size)
        assert chosen in able and cost(chosen) == best
        window, _ = levels.place(size, number)
        number += window == number


def test_letters_are_encoded_once_whatever_case_and_marks(monkeypatch):
    text = "Mot, mot*** MOT!!% mot' mot's l'Été été<| ß×÷ a.b x*** *** mot,\tmot"
    encoder, asked = Encoder(tokenizer_path()), []
    for name in ("_encode_pieces", "_encode_others"):
        encode = getattr(encoder, name)
        monkeypatch.setattr(encoder, name, lambda words, into, encode=encode: (asked.extend(words), encode(words, into)))
    (found,) = encoder([text])
    assert np.frombuffer(found, "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
    whole = ["mot's", "l'Été", "ß×÷", "a.b", "mot,\tmot"]
    assert sorted(asked) == sorted(["mot", "été", "x", "", ",", "***", "!!%", "'", "<|", *whole])
    assert encoder([text, "MOT***"]) == [found, encoder(["mot"])[0] + encoder(["***"])[0]]
    assert len(asked) == len(set(asked))


def test_a_full_memory_of_words_changes_no_ids(monkeypatch):
    texts = [f"eins zwei{'abcdefgh'[i % 8]} drei{'xyz' * (i % 5)}, vier**" for i in range(40)]
    wanted = Encoder(tokenizer_path())(texts)
    monkeypatch.setattr("ledgerflow.llm.packing.CACHED_WORDS", 5)
    small = Encoder(tokenizer_path())
    assert [small([t])[0] for t in texts] == wanted and len(small.young) <= 5
