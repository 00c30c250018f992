import random
import re
from collections import Counter

from pyspark.sql import functions as F

from ledgerflow.llm.catalog import misspelt
from ledgerflow.llm.spelling import near_words, variants, vocabulary


def near(word, words, alphabet):
    edits = {word[:i] + word[i + 1 :] for i in range(len(word))}
    edits |= {word[:i] + a + word[i + 1 :] for i in range(len(word)) for a in alphabet}
    edits |= {word[:i] + a + word[i:] for i in range(len(word) + 1) for a in alphabet}
    return (edits - {word}) & words.keys()


def brute(words, factor=10):
    alphabet = {c for w in words for c in w}
    found, form = {}, {}
    for word, n in words.items():
        around = near(word, words, alphabet)
        best = min(around, key=lambda x: (-words[x], x), default=None)
        form[word] = best if best is not None and words[best] >= factor * n else None
        found[word] = len(around)
    out = {}
    for word, n in words.items():
        root = word
        while form[root] is not None:
            root = form[root]
        out[word] = (form[word], root, n, found[word], words.get(form[word]))
    return out


def result(frame):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in frame.collect()}


def test_against_brute_force(spark):
    rng = random.Random(3)
    words = {"".join(rng.choice("aabé") for _ in range(rng.randint(0, 7))): rng.choice([1, 2, 7, 30, 300]) for _ in range(500)}
    words |= {"lll": 5, "ll": 50, "llll": 500, "l": 5000}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    assert result(variants(frame)) == brute(words)
    assert result(variants(frame, factor=2)) == brute(words, 2)


def test_long_chains_of_forms(spark):
    words = {"a" * i: 10 ** (12 - i) for i in range(1, 13)}
    found = result(variants(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert found == brute(words) and {v[1] for v in found.values()} == {"a"}


def test_vocabulary(spark, make):
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["Wording", "wordings", "éÀÿàüöä", "short", "x1abcdefgh2", "ABCDEFGÉ"]) for _ in range(200)) for _ in range(20)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "wording wording"), (3, None), (4, ""), (5, "a" * 300_000 + " " + "a" * 300_000)]
    docs = make(rows).selectExpr("*", "'clash' as run", "'clash' as word", "1 as n")
    want = Counter()
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    import zlib

    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(low)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                want[run] += 1
    found = vocabulary(docs, spelt=lambda run: misspelt(F.col("doc_id"), run))
    assert {r["word"]: r["n"] for r in found.collect()} == {w: n for w, n in want.items() if n >= 2}
    assert vocabulary(make([])).collect() == []
    assert variants(vocabulary(make([]))).collect() == []


def test_odd_vocabulary(spark):
    frame = spark.createDataFrame([(None, 5), ("", 40), ("a", 4), ("b", 400)], "word string, n long").selectExpr("*", "1 as `range`", "2 as whole")
    assert result(variants(frame)) == brute({"": 40, "a": 4, "b": 400})
    assert near_words(frame.where("word = 'zz'")).collect() == []
