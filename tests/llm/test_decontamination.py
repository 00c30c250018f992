import hashlib
import re

from ledgerflow.llm.catalog import QUERIES
from ledgerflow.llm.common import table
from ledgerflow.llm.decontamination import contamination, decontaminated, longest_matches

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    windows = {}
    for name, text in items:
        own = words(text)
        size = min(10, len(own))
        for k in range(len(own) - size + 1 if size else 0):
            windows.setdefault(tuple(own[k : k + size]), set()).add("" if name is None else str(name))
    sizes = {len(w) for w in windows}
    out = []
    for key, text in docs:
        own, hit, found = words(text), set(), set()
        for n in sizes:
            for k in range(len(own) - n + 1):
                if (w := tuple(own[k : k + n])) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[w]
        out.append((key, len(own), len(hit), sorted(found)))
    return out


def found(frame):
    rows = [(r["doc_id"], r["n_words"], sum(b - a for a, b in zip(r["span_starts"], r["span_ends"])), list(r["items"])) for r in frame.collect()]
    return sorted(rows, key=str)


def test_query_against_brute_force(spark):
    docs, bench = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    wanted = {k: (n, h, len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), h > 0) for k, n, h, i in brute(docs.select("doc_id", "text").collect(), bench.select("item_id", "text").collect())}
    got = {r[0]: tuple(r[1:6]) for r in QUERIES["op1_decontamination"](spark, SF).collect()}
    assert got == wanted and any(w[4] for w in wanted.values())


def test_odd_rows_and_blocks(spark, make, odd):
    items = [(1, "word " * 30), (None, "Same TEXT of two"), (3, None), (4, ""), (5, "a b"), (5, "b c"), (6, "same text of two"), (7, "é日本"), (10, "word word")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    wanted = sorted(brute(odd.select("doc_id", "text").collect(), items), key=str)
    assert found(contamination(odd, bench)) == wanted
    assert found(contamination(odd, bench, block_bytes=40)) == wanted
    left = decontaminated(odd, bench)
    assert left.columns == odd.columns
    assert left.count() == sum(not i for *_, i in wanted)
    assert found(contamination(odd, bench.limit(0))) == sorted(((k, n, 0, []) for k, n, _, _ in wanted), key=str)
    assert contamination(make([]), bench).collect() == []


def test_texts_do_not_run_together(spark, make):
    bench = spark.createDataFrame([(1, " ".join("abcdefghij"))], "item_id long, text string")
    docs = make([(1, "a b c d e"), (2, "f g h i j"), (3, "a b c d e f g h i j"), (4, "abc"), (5, "x a b c d e f g h i j a b c d e f g h i j y")])
    assert [r[2] for r in found(contamination(docs, bench))] == [0, 0, 10, 0, 20]


def test_longest_matches(spark, make):
    bench = spark.createDataFrame([(1, "one two three four"), (2, "zz")], "item_id long, text string")
    docs = make([(4, "so one two three"), (3, "two three four, one"), (9, "one two")])
    rows = {(r["item"], r["item_word"]): (r["words"], r["doc_id"], r["word"]) for r in longest_matches(docs, bench).collect()}
    assert rows == {("1", 0): (3, 4, 1), ("1", 1): (3, 3, 0), ("1", 2): (2, 3, 1), ("1", 3): (1, 3, 2)}


def test_long_words_of_one_polynomial_value(make, spark):
    """Words that agree in any polynomial hash modulo 2**64 are told apart."""
    flips = [bin(i).count("1") % 2 for i in range(1024)]
    one, other = "".join("ab"[f] for f in flips), "".join("ba"[f] for f in flips)
    rest = " ".join(f"w{i}" for i in range(9))
    items = spark.createDataFrame([("i1", f"{one} {rest}"), ("i2", f"{other} {rest}")], "item_id string, text string")
    found = contamination(make([(1, f"x {one} {rest} y"), (2, f"x {other.upper()} {rest}"), (3, rest)]), items)
    assert {r["doc_id"]: sorted(r["items"]) for r in found.collect()} == {1: ["i1"], 2: ["i2"], 3: []}
