"""Approximate nearest neighbours: a forest of random-projection trees, one queue for all trees, exact ranks."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ledgerflow.llm.common import map_arrow, record, schema, spread_left_join, written

TREES = 16
# Levels of a tree, and sampled vectors below which a node is a leaf.
DEPTH = 9
LEAF = 8
# Leaves of the forest that a query visits.
VISITS = 320
# The trees are grown on about so many vectors, drawn by a hash of their id; every vector is indexed.
SAMPLE = 20_000
# Bits of the leaf number within a task's group of leaves.
GROUP_BITS = 5
# Vectors, and queries, of one group of leaves that a task holds at once.
BLOCK = 20_000


class Tree:
    """Hyperplanes and children of the nodes; a child below 0 is the leaf ``-1 - child``."""

    def __init__(self, sample: np.ndarray, rng: np.random.Generator, depth: int, leaf: int):
        normals, thresholds, children = [], [], []
        self.leaves = 0

        def grow(rows: np.ndarray, level: int) -> int:
            if level < depth and len(rows) > leaf:
                a, b = sample[rng.choice(rows, 2, replace=False)]
                normal = a - b
                if not normal.any():
                    normal = rng.standard_normal(len(a))
                normal /= np.linalg.norm(normal)
                side = sample[rows] @ normal
                threshold = np.median(side)
                left = side < threshold
                if 0 < left.sum() < len(rows):
                    node = len(normals)
                    normals.append(normal)
                    thresholds.append(threshold)
                    children.append(None)
                    children[node] = (grow(rows[left], level + 1), grow(rows[~left], level + 1))
                    return node
            self.leaves += 1
            return -self.leaves

        self.root = grow(np.arange(len(sample)), 0)
        self.normals = np.array(normals).reshape(len(normals), sample.shape[1])
        self.thresholds = np.array(thresholds)
        self.children = children

    def leaf_of(self, vectors: np.ndarray) -> np.ndarray:
        at = np.full(len(vectors), self.root)
        children = np.array(self.children).reshape(-1, 2)
        while len(inner := np.flatnonzero(at >= 0)):
            node = at[inner]
            right = np.einsum("ij,ij->i", vectors[inner], self.normals[node]) >= self.thresholds[node]
            at[inner] = children[node, right.astype(int)]
        return -1 - at


class Forest:
    def __init__(self, sample: np.ndarray, trees: int, depth: int, leaf: int, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.trees = [Tree(sample, rng, depth, leaf) for _ in range(trees)]

    def visit(self, query: np.ndarray, visits: int) -> list[tuple[int, int]]:
        """The (tree, leaf) pairs nearest to the query: one queue over the nodes of all trees.

        A node waits with the sum of the squared margins of the planes that
        lie between it and the query.
        """
        margins = [(t.normals @ query - t.thresholds).tolist() for t in self.trees]
        queue = [(0.0, k, t.root) for k, t in enumerate(self.trees)]
        found: list[tuple[int, int]] = []
        while queue and len(found) < visits:
            off, k, node = heapq.heappop(queue)
            if node < 0:
                found.append((k, -1 - node))
                continue
            margin = margins[k][node]
            near, far = self.trees[k].children[node][:: -1 if margin >= 0 else 1]
            heapq.heappush(queue, (off, k, near))
            heapq.heappush(queue, (off + margin * margin, k, far))
        return found


def _matrix(column: pa.Array) -> np.ndarray:
    if not len(column):
        return np.zeros((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)


def _lifted(vectors: np.ndarray, largest: float) -> np.ndarray:
    """Vectors of one length whose distances to a query order as inner products do, largest first."""
    scaled = vectors / largest
    rest = np.sqrt(np.maximum(0.0, 1.0 - (scaled**2).sum(axis=1, keepdims=True)))
    return np.hstack((scaled, rest))


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v) of the vectors that take part: a key, no null or non-finite component, not zero, the usual length.

    Of vectors of several lengths those of the most frequent one take part (of equals, the longest).
    """
    v = F.col("v")
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col(key).alias("id"), F.col(vector).alias("v")).where(
        F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0)
    )
    rows = rows.where(~odd).where(F.exists(v, lambda x: x != 0))
    lengths = rows.groupBy(F.size(v).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return rows.where(F.size(v) == (lengths[0]["d"] if lengths else 0))


def nearest(
    vectors: DataFrame,
    is_query: F.Column,
    *,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = 20,
    trees: int = TREES,
    depth: int = DEPTH,
    leaf: int = LEAF,
    visits: int = VISITS,
    sample: int = SAMPLE,
    block: int = BLOCK,
) -> DataFrame:
    """The ``k`` nearest of each query: ``query_id``, ``rank`` from 1, ``vec_id``, ``score`` (inner product).

    Queries are the rows where ``is_query`` holds (of columns of ``vectors``);
    all rows but the query's own are candidates. Equal scores rank by key.
    Vectors that ``usable`` leaves out neither ask nor answer; of rows repeating
    a key and vector one takes part. An empty table gives no row.

    Equal vectors are one class that is indexed and asked once, with its
    ``k + 1`` least keys as members: a very common vector is one entry. The
    forest grows on a bounded sample and is broadcast; each class is put in its
    leaf of every tree, each asked class visits the leaves its queue yields,
    and they meet in groups of neighbouring leaves cut into blocks of at most
    ``block`` vectors and queries. Members are all scored exactly.
    """
    spark = vectors.sparkSession
    ids = written(usable(vectors, key, vector).distinct(), "vectors")
    asks = vectors.where(is_query).select(F.col(key).alias("id")).where("id is not null").distinct()
    classes = written(
        ids.groupBy("v").agg(F.min("id").alias("c"), F.count("*").alias("n")), "classes"
    )
    answer = T.StructType(
        [
            T.StructField("query_id", vectors.schema[key].dataType),
            T.StructField("rank", T.IntegerType()),
            T.StructField("vec_id", vectors.schema[key].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )
    stats = classes.agg(
        F.count("*").alias("n"),
        F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x))).alias("largest"),
    ).first()
    if not stats["n"]:
        return spark.createDataFrame([], answer)
    share = min(1.0, sample / stats["n"])
    drawn = classes.where(F.pmod(F.xxhash64("c"), F.lit(1_000_000)) < int(1e6 * share) + 1).select("c", "v").orderBy("c")
    grown = _matrix(drawn.toArrow()["v"].combine_chunks())
    if not len(grown):
        grown = _matrix(classes.orderBy("c").limit(1).toArrow()["v"].combine_chunks())
    largest = float(stats["largest"])
    forest = spark.sparkContext.broadcast(Forest(_lifted(grown, largest), trees, depth, leaf))

    # Query keys by class; the classes that are asked.
    keyed = ids.join(asks, "id", "left_semi")
    counts = classes.select("v", "n")
    asked = written(
        spread_left_join(keyed, classes.select("v", "c"), "v", counts, F.xxhash64("id")).select("id", "c"), "asked"
    )
    asking = classes.join(asked.select("c").distinct(), "c", "left_semi").select("c", "v")

    entry = schema(("cell", "int"), ("leaf", "int"), classes.schema["c"], classes.schema["v"])
    visit = schema(("cell", "int"), ("leaves", "array<int>"), classes.schema["c"], classes.schema["v"])

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lifted = _lifted(_matrix(batch.column("v")), largest)
            for number, tree in enumerate(forest.value.trees):
                at = tree.leaf_of(lifted)
                cell = number << 16 | at >> GROUP_BITS
                yield record(entry, {"cell": cell, "leaf": at, "c": batch.column("c"), "v": batch.column("v")})

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _matrix(batch.column("v"))
            found = np.hstack((found / np.linalg.norm(found, axis=1, keepdims=True), np.zeros((len(found), 1))))
            rows, cells, leaves = [], [], []
            for row, query in enumerate(found):
                own: dict[int, list[int]] = {}
                for number, at in forest.value.visit(query, visits):
                    own.setdefault(number << 16 | at >> GROUP_BITS, []).append(at)
                rows += [row] * len(own)
                cells += own
                leaves += own.values()
            taken = pa.array(rows, pa.int32())
            yield record(
                visit,
                {"cell": cells, "leaves": leaves, "c": batch.column("c").take(taken), "v": batch.column("v").take(taken)},
            )

    # Only ids and cells are counted; the counts say how many blocks a cell has.
    entries = written(map_arrow(classes.select("c", "v"), index, entry), "index")
    visitors = written(map_arrow(asking, ask, visit), "visits")

    def blocked(rows: DataFrame, other: DataFrame, own: str, others: str) -> DataFrame:
        """Rows with their own block, copied for each block of the other side."""
        mine = rows.groupBy("cell").count().select("cell", F.ceil(F.col("count") / block).cast("int").alias("mine"))
        theirs = other.groupBy("cell").count().select("cell", F.ceil(F.col("count") / block).cast("int").alias("theirs"))
        return (
            rows.join(mine.join(theirs, "cell"), "cell")
            .withColumn(own, F.pmod(F.xxhash64("c"), F.col("mine")).cast("int"))
            .withColumn(others, F.explode(F.sequence(F.lit(0), F.col("theirs") - 1)))
            .drop("mine", "theirs")
        )

    best = schema(("q", vectors.schema[key].dataType.simpleString()), ("near", f"array<{vectors.schema[key].dataType.simpleString()}>"), ("scores", "array<double>"))

    def meet(queries: pa.Table, members: pa.Table) -> pa.Table:
        if not queries.num_rows or not members.num_rows:
            return _table(best, [], [], [])
        points = _matrix(members["v"].combine_chunks())
        asked_for = _matrix(queries["v"].combine_chunks())
        names = members["c"].to_numpy()
        order = np.argsort(members["leaf"].to_numpy(), kind="stable")
        ordered = members["leaf"].to_numpy()[order]
        near, scores = [], []
        for query, leaves in zip(asked_for, queries["leaves"].to_pylist()):
            some = np.concatenate(
                [order[np.searchsorted(ordered, x, "left") : np.searchsorted(ordered, x, "right")] for x in leaves]
            )
            score = points[some] @ query
            if len(some) > k + 1:
                least = np.partition(score, len(score) - k - 1)[len(score) - k - 1]
                keep = np.flatnonzero(score >= least)
                keep = keep[np.lexsort((names[some[keep]], -score[keep]))][: k + 1]
                some, score = some[keep], score[keep]
            near.append(names[some])
            scores.append(score)
        return _table(best, queries["c"], near, scores)

    pair = ["cell", "i", "j"]
    met = (
        blocked(visitors, entries, "i", "j")
        .groupBy(*pair)
        .cogroup(blocked(entries, visitors, "j", "i").groupBy(*pair))
        .applyInArrow(meet, best)
    )

    def merge(parts: pa.Table) -> pa.Table:
        near = np.concatenate([np.asarray(x) for x in parts["near"].to_pylist()])
        scores = np.concatenate([np.asarray(x, float) for x in parts["scores"].to_pylist()])
        near, first = np.unique(near, return_index=True)
        scores = scores[first]
        order = np.lexsort((near, -scores))[: k + 1]
        return _table(best, parts["q"][:1], [near[order]], [scores[order]])

    # The classes next to each asked class, then their members, then the asked class's own keys.
    tops = met.where(F.size("near") > 0).groupBy("q").applyInArrow(merge, best)
    ranked = Window.partitionBy("v").orderBy("id")
    members = (
        ids.withColumn("r", F.row_number().over(ranked))
        .where(F.col("r") <= k + 1)
        .groupBy("v")
        .agg(F.array_sort(F.collect_list("id")).alias("ids"))
        .select(F.col("ids")[0].alias("c"), "ids")
    )
    listed = (
        tops.select("q", F.explode(F.arrays_zip("near", "scores")).alias("x"))
        .select("q", F.col("x.near").alias("c"), F.col("x.scores").alias("score"))
        .join(members, "c")
        .select("q", "score", F.explode("ids").alias("id"))
        .groupBy("q")
        .agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "id"))).alias("all"))
        .select(F.col("q").alias("c"), F.slice("all", 1, k + 1).alias("all"))
    )
    answered = spread_left_join(
        asked, listed, "c", asked.groupBy("c").agg(F.count("*").alias("n")), F.xxhash64("id")
    )
    others = F.slice(F.filter("all", lambda x: x["id"] != F.col("id")), 1, k)
    return answered.select(F.col("id").alias("query_id"), F.posexplode(others).alias("rank", "x")).select(
        "query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"), (-F.col("x.s")).alias("score")
    )


def _table(schema_: T.StructType, queries, near: list, scores: list) -> pa.Table:
    queries = queries.combine_chunks() if isinstance(queries, pa.ChunkedArray) else pa.array(queries, pa.int64())
    return pa.Table.from_batches([record(schema_, {"q": queries, "near": near, "scores": scores})])
