import random
import re

import numpy as np
import xxhash

from ledgerflow.llm.common import table
from ledgerflow.llm.simhash import fingerprint, near_duplicates, representatives

SF = "/root/testdata/sf0.001"


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(rows):
    """Least id reachable by links of at most 4 bits, by brute force."""
    prints = [plain(t) for _, t in rows]
    fp = np.array(prints, np.uint64)
    label = np.arange(len(rows))
    while True:
        old = label.copy()
        for i in range(len(rows)):
            near = np.bitwise_count(fp ^ fp[i]) <= 4
            label[near] = label[near].min()
        if (old == label).all():
            break
    ids = [i for i, _ in rows]
    least = {x: min((ids[k] for k in np.flatnonzero(label == x) if ids[k] is not None), default=None) for x in set(label.tolist())}
    return prints, [least[x] for x in label.tolist()]


def texts(seed=3):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = []
    for base in range(40):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([3, 30, 400]))]
        for copy in range(rng.choice([1, 1, 4, 12])):
            own = list(words)
            for _ in range(copy // 2):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            rows.append(" ".join(own))
    rng.shuffle(rows)
    return [(i, t) for i, t in enumerate(rows)] + [(900, ""), (901, None), (902, " \t\n"), (903, "One two"), (904, "one  TWO")]


def test_fingerprint_is_the_definition():
    for text in ["", "a", "A b\x0bC", "É é a b c d e", "a b c d e f g a b c d", "x\ny\rz t u"]:
        assert fingerprint(text.encode()) == plain(text)


def test_classes_against_brute_force(make):
    rows = texts()
    prints, wanted = classes(rows)
    got = {r["doc_id"]: r for r in near_duplicates(make(rows)).collect()}
    for (key, _), fp, root in zip(rows, prints, wanted):
        assert got[key]["fp"] % (1 << 64) == fp and got[key]["component_id"] == root


def test_small_blocks_lose_no_link(spark, make):
    from pyspark.sql import functions as F

    from ledgerflow.llm.components import components
    from ledgerflow.llm.simhash import links

    rng = np.random.default_rng(1)
    fp = np.unique(np.concatenate([c ^ (np.uint64(1) << rng.integers(0, 64, 60).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 60).astype(np.uint64)) for c in rng.integers(0, 1 << 63, 5).astype(np.uint64)]))
    frame = spark.createDataFrame([(int(x),) for x in fp.view(np.int64)], "fp long")
    roots = [dict(components(links(frame, block=b)).select("node", "root").collect()) for b in (7, 8192)]
    grouped = [sorted(sorted(k for k in [*r, *r.values()] if r.get(k, k) == v) for v in set(r.values())) for r in roots]
    assert grouped[0] == grouped[1] and len(grouped[0]) == 5
    assert links(frame).agg(F.count("*")).first()[0] <= 5 * len(fp)


def test_documents(spark):
    docs = table(spark, SF, "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    prints, wanted = classes(rows)
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(docs).collect()}
    assert got == dict(zip([k for k, _ in rows], wanted))
    assert {r["doc_id"] for r in representatives(docs).collect()} == set(wanted)


def test_odd_rows(odd, make):
    rows = near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    assert {r["component_id"] for r in rows if r["doc_id"] in (1, 2, 3)} == {1}
    assert {r["component_id"] for r in rows if r["doc_id"] in (6, 7)} == {6}
    kept = representatives(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] for r in kept.where("doc_id is not null").collect()) == [1, 4, 5, 6, 6, 8]
    assert near_duplicates(make([])).collect() == []
