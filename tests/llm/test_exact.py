import hashlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from ledgerflow.llm import exact

LOW = str.maketrans(exact.UPPER, exact.LOWER)


def brute(rows):
    same = defaultdict(list)
    for key, text in rows:
        same[(text or "").translate(LOW)].append(key)
    found = Counter()
    for text, keys in same.items():
        best = max((k for k in keys if k is not None), default=None)
        sha = hashlib.sha256(text.encode()).hexdigest()
        for i, key in enumerate(keys):
            found[key, best, len(keys), i == keys.index(best), sha] += 1
    return found


def rows_of_copies():
    rows = [(i, f"text {i % 90} of many É" if i % 2 else f"TEXT {i % 90} of many É") for i in range(400)]
    rows += [(1000 + i, "one copied text " * 20) for i in range(600)]
    rows += [(2000 + i, "y" * 30_000 + "aA"[i % 2]) for i in range(12)]
    return rows + [(None, None)] * 30 + [(None, "")] * 30 + [(9000, "One copied TEXT " * 20)] * 3 + [(7, "é"), (8, "É")]


@pytest.mark.parametrize("bucket_bytes, batch_bytes", [(4 << 20, 8 << 20), (60_000, 20_000), (2_000, 2_000)])
def test_against_brute_force(spark, monkeypatch, bucket_bytes, batch_bytes):
    """Small buckets go through further levels of spill files, the copied text through shares."""
    monkeypatch.setattr(exact, "BATCH_BYTES", batch_bytes)
    rows = rows_of_copies()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(13)
    found = exact.groups(docs, bucket_bytes=bucket_bytes).collect()
    assert Counter(tuple(r) for r in found) == brute(rows)


def test_table_owners_with_one_hash():
    """Content decides, not the hash."""
    texts = ["a", "b", "a", "", "b", "c", ""]
    owner = exact.table_owners(np.zeros(7, np.int64), pa.array([t.encode() for t in texts], pa.large_binary()))
    assert owner.tolist() == [0, 1, 0, 3, 1, 5, 3]


def test_unique_and_odd_rows(odd, make):
    rows = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    assert Counter(tuple(r) for r in exact.groups(odd).collect()) == brute(rows)
    kept = exact.unique(odd)
    assert kept.columns == odd.columns
    texts = [(r["doc_id"], r["text"] or "") for r in kept.collect()]
    assert len(texts) == len({(t or "").translate(LOW) for _, t in rows})
    assert (7, "same text of two rows here") in texts and (2, "") in texts
    assert exact.groups(make([])).collect() == [] and exact.unique(make([])).collect() == []


def test_text_keys(spark):
    docs = spark.createDataFrame([("b", "x"), ("é", "X"), (None, "x")], "id string, body string")
    found = {(r["key"], r["keep"], r["size"], r["kept"]) for r in exact.groups(docs, "id", "body").collect()}
    assert found == {("b", "é", 3, False), ("é", "é", 3, True), (None, "é", 3, False)}
