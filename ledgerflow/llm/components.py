"""Connected components of a graph given as edges, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import written

MAX_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an edge (a, b) other than a root itself.

    Each round hangs the larger neighbours of a node, then the smaller ones,
    on the least of them, until every component is a star around its least
    node. The edges never outnumber those given, each round is written to the
    shared folder, and only a count and a sum of hashes reach the driver.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    edges = written(edges.select(high.alias("a"), low.alias("b")).where("a > b").distinct(), "edges")
    state = None
    for _ in range(MAX_ROUNDS):
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state or now[0] == 0:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = now
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (
            both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        )
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        edges = written(
            small.select("b", "m")
            .union(least.select("a", "m"))
            .toDF("a", "b")
            .where("a > b")
            .distinct(),
            "edges",
        )
    raise RuntimeError(f"components not settled after {MAX_ROUNDS} rounds")
