"""Near duplicates by 64-bit SimHash: popcount embedding, grid range-join, exact check."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import map_arrow, record, schema, shards, spread_left_join, written
from ledgerflow.llm.components import components

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
# Fingerprints of a grid cell that one task compares with one another.
BLOCK = 8192
# Rows of the comparison that are held against a block at once.
STRIP = 512


def fingerprint(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """Majority bits of the hashes of all shingles of a text."""
    tokens = text.lower().split()  # of bytes: A-Z only, and white space 20, 09-0D
    if not tokens:
        return 0
    line = b" ".join(tokens)
    if len(tokens) <= words:
        return xxhash.xxh64_intdigest(line, SEED)
    ends = np.cumsum([len(t) + 1 for t in tokens])
    starts = np.concatenate(([0], ends[:-words])).tolist()
    ends = (ends[words - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], SEED) for a, b in zip(starts, ends)], "<u8")
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return int(np.packbits(bits.sum(axis=0) * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", words: int = SHINGLE_WORDS, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns and ``fp``, the fingerprint as a signed long (null or blank text: 0)."""
    out = schema(*[docs.schema[c] for c in keep], ("fp", "long"))

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in shards(batches, text):
            values = [fingerprint((t or "").encode(), words) for t in shard.column(text).to_pylist()]
            columns = {c: shard.column(c) for c in keep}
            yield record(out, columns | {"fp": np.array(values, np.uint64).view(np.int64)})

    return map_arrow(docs.select(*dict.fromkeys([*keep, text])), compute, out)


def grid_masks(max_bits: int) -> list[int]:
    """The 32 two-bit segments dealt to ``max_bits + 1`` groups, as masks over the embedding."""
    groups = max_bits + 1
    masks = [0] * groups
    for segment in range(32):
        masks[segment % groups] |= 3 << (2 * segment)
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(fps: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """A spanning set of edges (a, b) between distinct fingerprints at most ``max_bits`` apart.

    Each fingerprint is embedded as the popcounts of its two-bit segments; the
    Manhattan distance of two embeddings never exceeds the number of differing
    bits. Of ``max_bits + 1`` groups of segments, one must agree in full, so a
    pair meets in the grid cell of that group. Inside a cell rows are ordered
    by total popcount and meet only those within ``max_bits`` of it (the bound
    over the whole word); the differing bits decide.

    A cell of more than ``block`` fingerprints is cut into blocks and each pair
    of blocks is a task's group of its own, so no group exceeds two blocks. A
    group returns its local components as stars: at most one edge for a
    fingerprint, however dense the cell.
    """
    # Low bits of all segments; a segment's count in two bits is (high and low, high xor low).
    low = F.lit(0x5555555555555555)
    odd, even = F.col("fp").bitwiseAND(low), F.shiftrightunsigned("fp", 1).bitwiseAND(low)
    embedded = F.shiftleft(odd.bitwiseAND(even), 1).bitwiseOR(odd.bitwiseXOR(even))
    cells = fps.select("fp", embedded.alias("e")).select(
        "fp",
        F.posexplode(F.array(*[F.col("e").bitwiseAND(F.lit(m)) for m in grid_masks(max_bits)])).alias("g", "cell"),
    )
    sizes = cells.groupBy("g", "cell").agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / block).cast("int")
    mine = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("blocks")).cast("int")
    paired = (
        cells.join(sizes.withColumn("blocks", blocks).drop("n"), ["g", "cell"])
        .withColumn("own", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("g", "cell", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "fp")
    )
    out = schema(("a", "long"), ("b", "long"))

    def near(group: pa.Table) -> pa.Table:
        fp = group["fp"].to_numpy()
        own = group["own"].to_numpy()
        across = group["i"][0].as_py() != group["j"][0].as_py()
        a, root = _local_components(fp.view(np.uint64), own if across else None, max_bits)
        return pa.table({"a": fp[a], "b": fp[root]})

    return paired.groupBy("g", "cell", "i", "j").applyInArrow(near, out)


def _local_components(fp: np.ndarray, side: np.ndarray | None, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices of rows and of the row their component is named by, for rows that have links.

    With ``side`` only pairs of rows of different sides count.
    """
    ones = np.bitwise_count(fp).astype(np.int64)
    order = np.argsort(ones, kind="stable")
    fp, ones = fp[order], ones[order]
    side = None if side is None else side[order]
    label = np.arange(len(fp))
    for start in range(0, len(fp), STRIP):
        stop = min(start + STRIP, len(fp))
        # Later rows only: each pair once.
        far = np.searchsorted(ones, ones[stop - 1] + max_bits, "right")
        close = np.bitwise_count(fp[start:stop, None] ^ fp[None, start:far]) <= max_bits
        if side is not None:
            close &= side[start:stop, None] != side[None, start:far]
        rows = np.flatnonzero(close.sum(axis=1) > (side is None))
        for row in rows:
            met = np.unique(label[np.append(start + np.flatnonzero(close[row]), start + row)])
            if len(met) > 1:
                label[np.isin(label, met[1:])] = met[0]
    moved = np.flatnonzero(label != np.arange(len(fp)))
    return order[moved], order[label[moved]]


def near_duplicates(
    docs: DataFrame, text: str = "text", key: str = "doc_id", words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """``key``, ``fp`` and ``component_id`` of every row of ``docs``.

    Equal fingerprints are one node, so copies never form pairs; an empty text
    has fingerprint 0, a node like any other. ``component_id`` is the least key
    that links reach, the row's own included; null keys are ignored by it, and
    it is null where all are. Repeated rows stay; an empty table gives no row.
    """
    prints = written(fingerprints(docs, text, words, (key,)), "simhash")
    nodes = written(prints.groupBy("fp").agg(F.min(key).alias("first"), F.count("*").alias("n")), "nodes")
    roots = components(links(nodes.select("fp"), max_bits))
    grouped = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    named = grouped.groupBy("root").agg(F.min("first").alias("component_id"))
    names = grouped.select("fp", "root").join(named, "root").select("fp", "component_id")
    return spread_left_join(prints, names, "fp", nodes.select("fp", "n"), F.xxhash64(key)).select(
        key, "fp", "component_id"
    )


def representatives(docs: DataFrame, text: str = "text", key: str = "doc_id", words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """The documents, one of each group: the one with the least key.

    Rows without key belong to no group and stay; of rows repeating a kept key
    all stay, since nothing tells them apart.
    """
    classes = near_duplicates(docs, text, key, words, max_bits)
    drop = classes.where(F.col("component_id") < F.col(key)).select(F.col(key).alias("dropped")).distinct()
    return docs.join(drop, docs[key] == drop["dropped"], "left_anti")
