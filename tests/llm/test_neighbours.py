import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerflow.llm.catalog import QUERIES
from ledgerflow.llm.common import table
from ledgerflow.llm.neighbours import nearest

SF = "/root/testdata/sf0.1"
SCHEMA = "vec_id long, embedding array<float>, label int"


def exact(rows, queries, k=20):
    ids = np.array([i for i, _ in rows])
    vectors = np.array([v for _, v in rows], float)
    out = {}
    for q in queries:
        score = vectors @ vectors[ids == q][0]
        order = [i for i in np.lexsort((ids, -np.round(score, 9))) if ids[i] != q][:k]
        out[q] = [(int(ids[i]), float(score[i])) for i in order]
    return out


def answers(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_recall_against_brute_force(spark):
    rows = [(r["vec_id"], list(r["embedding"])) for r in table(spark, SF, "embeddings").collect()]
    wanted = exact(rows, [i for i, _ in rows if i % 20 == 0])
    got = answers(QUERIES["op10_neighbours"](spark, SF))
    assert set(got) == set(wanted) and all(len(v) == 20 for v in got.values())
    found = sum(len({i for i, _ in got[q]} & {i for i, _ in wanted[q]}) for q in wanted)
    assert found / (20 * len(wanted)) >= 0.9


def test_common_vectors_ties_and_lengths(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [1.0, 2.0, -1.0, 0.5]) for i in range(60)] + [(i, (rng.standard_normal(4) * rng.uniform(0.1, 5)).astype("f4").tolist()) for i in range(60, 160)]
    odd = [(None, [1.0] * 4), (200, None), (220, [0.0] * 4), (240, [1.0, None, 1.0, 1.0]), (260, [float("nan")] * 4), (280, [float("inf"), 0.0, 0.0, 1.0]), (300, []), (320, [1.0, 2.0]), (60, rows[60][1])]
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows + odd], SCHEMA)
    got = answers(nearest(frame, F.col("vec_id") % 20 == 0, block=7))
    wanted = exact(rows, [i for i, _ in rows if i % 20 == 0])
    assert set(got) == set(wanted)
    for q in wanted:
        assert [i for i, _ in got[q]] == [i for i, _ in wanted[q]]
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in wanted[q]])


def test_few_and_none(spark):
    frame = spark.createDataFrame([(0, [1.0, 0.0], 0), (1, [0.5, 0.5], 0), (2, [-1.0, 0.0], 0)], SCHEMA)
    assert answers(nearest(frame, F.col("vec_id") % 20 == 0)) == {0: [(1, 0.5), (2, -1.0)]}
    assert nearest(frame.limit(0), F.col("vec_id") % 20 == 0).collect() == []
    assert nearest(frame.where("vec_id = 0"), F.col("vec_id") % 20 == 0).collect() == []
