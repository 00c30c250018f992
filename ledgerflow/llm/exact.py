"""Exact duplicates: records spilled by hash, again and again, until each bucket fits a table."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ledgerflow.llm.common import apart, map_arrow, record, schema, shards, text_bytes, together, written

# Bytes of records that one open-addressing table takes.
BUCKET_BYTES = 4 << 20
# Text whose equal rows are put together before anything is shuffled.
BATCH_BYTES = 8 << 20
# What a record or a member counts besides its text.
ROW_BYTES = 64
MEMBER_BYTES = 8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lowered(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z in lower case; no byte of a longer UTF-8 sequence is one of them."""
    return data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)


def table_owners(hashes: np.ndarray, texts: pa.Array) -> np.ndarray:
    """The first row with the same content, for every row: an open-addressing table of the rows.

    All rows probe together. Rows of one content start at one slot and step on
    together, so they meet the same holder, and only equal content ends a walk.
    """
    rows = len(hashes)
    size = 1 << (2 * rows + 1).bit_length()
    slots = np.full(size, -1, np.int64)
    mixed = hashes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    slot = (mixed >> np.uint64(64 - size.bit_length() + 1)).astype(np.int64)
    owner = np.full(rows, -1, np.int64)
    walking = np.arange(rows)
    while len(walking):
        at = slot[walking]
        free = slots[at] < 0
        # Written from the last to the first: a free slot goes to the least row that probes it.
        slots[at[free][::-1]] = walking[free][::-1]
        holder = slots[at]
        same = holder == walking
        others = np.flatnonzero(~same & (hashes[holder] == hashes[walking]))
        if len(others):
            equal = pc.equal(texts.take(pa.array(holder[others])), texts.take(pa.array(walking[others])))
            same[others] = equal.to_numpy(zero_copy_only=False)
        owner[walking[same]] = holder[same]
        walking = walking[~same]
        slot[walking] = (slot[walking] + 1) & (size - 1)
    return owner


def _winners(owner: np.ndarray, keys: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The owners, and the row of each with the largest key (null is less than any; of ties, the first)."""
    order = pc.array_sort_indices(keys, order="descending", null_placement="at_end").to_numpy()
    by_owner = order[np.argsort(owner[order], kind="stable")]
    owners, first = np.unique(owner[by_owner], return_index=True)
    return owners, by_owner[first]


def _record_schema(key: T.DataType) -> T.StructType:
    return schema(
        ("rec", "long"),
        ("hash", "long"),
        ("sha", "binary"),
        ("text", "binary"),
        ("n", "long"),
        T.StructField("top", key),
        T.StructField("members", T.ArrayType(key)),
        ("at", "int"),
    )


def _combined(docs: DataFrame, key: str, text: str) -> DataFrame:
    """One record for each content of a batch, with the keys of its rows; ``at`` is the place of its largest."""
    kind = docs.schema[key].dataType
    out = _record_schema(kind)

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 36
        for batch in shards(batches, "t", BATCH_BYTES, ROW_BYTES):
            data, offsets = text_bytes(batch.column("t"))
            data = _lowered(data)
            ends = pa.py_buffer(offsets.astype(np.int64).tobytes())
            texts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(batch), [None, ends, pa.py_buffer(data.tobytes())])
            view = memoryview(data)
            shas = [hashlib.sha256(view[a:b]).digest() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            hashes = np.frombuffer(b"".join(s[:8] for s in shas), np.int64)
            keys = batch.column("k")
            owner = table_owners(hashes, texts)
            owners, best = _winners(owner, keys)
            order = np.argsort(owner, kind="stable")
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            starts = np.searchsorted(owner[order], owners)
            bounds = np.append(starts, len(order))
            yield record(
                out,
                {
                    "rec": number + np.arange(len(owners)),
                    "hash": hashes[owners],
                    "sha": [shas[i] for i in owners.tolist()],
                    "text": texts.take(pa.array(owners)),
                    "n": np.diff(bounds),
                    "top": keys.take(pa.array(best)),
                    "members": pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), keys.take(pa.array(order))),
                    "at": (place[best] - starts).astype(np.int32),
                },
            )
            number += len(owners)

    rows = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").cast("binary").alias("t"))
    return map_arrow(rows, combine, out)


def _merged(records: DataFrame, by: list[str], key: T.DataType, carry: bool = False) -> DataFrame:
    """The records of each bucket in one table, with their class: its first record, size and largest key.

    ``won`` marks the record that holds the row to keep. To be merged further,
    the first record of a class carries its ``text`` on.
    """
    given = [*_record_schema(key).names, "depth"]
    out = schema(*_record_schema(key), ("depth", "int"), ("cid", "long"), ("won", "boolean"))

    def merge(bucket: pa.Table) -> pa.Table:
        # In one order, whatever the order of arrival.
        bucket = bucket.select(given).sort_by("rec").combine_chunks()
        column = {c: pc.cast(bucket.column(c).combine_chunks(), pa.large_binary()) if c == "text" else
                  bucket.column(c).combine_chunks() for c in given}
        owner = table_owners(column["hash"].to_numpy(), column["text"])
        owners, best = _winners(owner, column["top"])
        of = np.searchsorted(owners, owner)
        sums = np.zeros(len(owners), np.int64)
        np.add.at(sums, of, column["n"].to_numpy())
        rows = np.arange(len(owner))
        column |= {
            "cid": column["rec"].take(pa.array(owner)),
            "text": pc.if_else(pa.array((owner == rows) & carry), column["text"], pa.scalar(None, pa.large_binary())),
            "n": sums[of],
            "top": column["top"].take(pa.array(best[of])),
            "won": best[of] == rows,
        }
        return pa.Table.from_batches([record(out, column)])

    return records.select(*by, *given).groupBy(*by).applyInArrow(merge, out)


def _weight() -> F.Column:
    return F.octet_length("text") + F.lit(ROW_BYTES) + F.lit(MEMBER_BYTES) * F.size("members")


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(key, keep, size, kept, sha) of every row of ``docs``: its group of equal texts.

    Texts are equal when identical after lower-casing A-Z. ``keep`` is the
    group's largest key, ``kept`` marks the one row that stays, ``sha`` is the
    normalised text's SHA-256. A null text counts as empty; null keys are less
    than any other; of rows that tie in text and key one stays. No row is
    dropped, an empty table gives no row, other columns are not read and may
    have any name; a text is held whole, however long.

    Equal rows of a batch become one record before anything moves. Records are
    spilled to files under a bucket number; what overflows a table goes to
    further files by the next level's hash, until each bucket fits. A content
    whose records alone overflow can't be told apart by any hash: its records
    are dealt out by number, each share is merged to one record, and those are
    spilled in turn, at most half as many each time.
    """
    kind = docs.schema[key].dataType
    read = F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)) + F.lit(ROW_BYTES)
    fan = 1 + 2 * (docs.agg(F.sum(read.cast("long"))).first()[0] or 0) // bucket_bytes
    pending = written(
        _combined(docs, key, text).withColumns({"bucket": F.pmod(F.xxhash64("hash"), F.lit(fan)), "depth": F.lit(0)}),
        "spill",
    )
    columns = pending.columns
    solved, shares = [], []
    for level in count(1):
        sizes = pending.groupBy("bucket").agg(
            F.sum(_weight()).alias("bytes"), F.count("*").alias("rows"), (F.min("hash") != F.max("hash")).alias("many")
        )
        # At most total / bucket_bytes rows, mostly none: Spark picks the joins by the written size.
        over = written(sizes.where((F.col("bytes") > bucket_bytes) & (F.col("rows") > 1)), "overflow")
        solved.append(_merged(pending.join(over, "bucket", "left_anti"), ["bucket"], kind))
        if over.isEmpty():
            return _labels(solved, shares)
        parts = F.lit(1) + F.floor(F.col("bytes") * 2 / bucket_bytes)
        rest = pending.join(over.withColumn("parts", parts), "bucket")
        sub = F.xxhash64("bucket", F.pmod(F.xxhash64("hash", F.lit(level)), F.col("parts")))
        further = rest.where("many").withColumn("bucket", sub).select(*columns)
        dealt = F.pmod(F.xxhash64("rec", F.lit(level)), F.least("parts", F.floor((F.col("rows") + 1) / 2)))
        one = rest.where("not many").withColumn("share", dealt)
        shares.append(written(_merged(one, ["bucket", "share"], kind, carry=True), "shares"))
        firsts = shares[-1].where("rec = cid").withColumns(
            {"members": F.slice("members", 1, 0), "at": F.lit(0), "bucket": F.col("hash"), "depth": F.lit(len(shares))}
        )
        pending = written(further.union(firsts.select(*columns)), "spill")


def _labels(solved: list[DataFrame], shares: list[DataFrame]) -> DataFrame:
    """The outcome of each record handed down to the records merged into it, then to their rows."""
    columns = ["depth", "rec", "members", "at", "won", "top", "n", "sha"]
    known = reduce(DataFrame.union, [s.select(*columns) for s in solved])
    if shares:
        known = written(known, "solved")
    for depth in range(len(shares), 0, -1):
        upper = known.where(F.col("depth") == depth).select(F.col("rec").alias("cid"), F.col("won").alias("up"), "top", "n")
        lower = shares[depth - 1].drop("top", "n").join(upper, "cid").withColumn("won", F.col("won") & F.col("up"))
        known = known.union(lower.select(*columns))
    return known.select("*", F.posexplode("members").alias("place", "key")).select(
        "key",
        F.col("top").alias("keep"),
        F.col("n").alias("size"),
        (F.col("won") & (F.col("place") == F.col("at"))).alias("kept"),
        F.lower(F.hex("sha")).alias("sha"),
    )


def unique(docs: DataFrame, key: str = "doc_id", text: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """The row of each group that ``groups`` keeps, with all its columns.

    Rows that repeat key and text are one. Odd rows: see ``groups``.
    """
    found = groups(docs, key, text, bucket_bytes).where("kept")
    content = F.coalesce(F.col("body").cast("string"), F.lit(""))
    same = F.struct(F.col(f"row.`{key}`").alias("key"), F.sha2(F.translate(content, UPPER, LOWER), 256).alias("sha"))
    named = apart(docs, text).withColumn("same", same)
    stays = named.join(found.select(F.struct("key", "sha").alias("same")), "same", "left_semi")
    first = F.row_number().over(Window.partitionBy("same").orderBy("body"))
    return stays.withColumn("first", first).where("first = 1").select(*together(docs, docs.columns, text))
