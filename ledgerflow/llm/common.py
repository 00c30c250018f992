"""Helpers shared by the operators: tables, written steps and Arrow shards."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.session import shared_folder

# Text that one pass of a vectorised function takes at once; a longer document is one shard.
SHARD_BYTES = 1 << 20
# Rows of one Arrow batch: small, because a row can be very long. Batches are joined to shards.
BATCH_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path in the folder that all executors share."""
    return f"{shared_folder(spark)}/llm-{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows as a written table: later steps read files and keep no lineage."""
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_arrow(df: DataFrame, fn: Callable, schema: T.StructType) -> DataFrame:
    """``mapInArrow`` in batches of few rows, so that long texts stay within memory."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df.mapInArrow(fn, schema)


def apart(df: DataFrame, text: str, *more: F.Column) -> DataFrame:
    """The rows as ``row`` (all other columns) and ``body`` (the text), so that no added name clashes."""
    return df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns if c != text], F.lit(0).alias("_")).alias("row"),
        F.col(text).alias("body"),
        *more,
    )


def together(df: DataFrame, columns: list[str], text: str) -> list[F.Column]:
    """The columns that ``apart`` took apart, in their order."""
    return [F.col("body").alias(c) if c == text else F.col(f"row.`{c}`") for c in columns]


def schema(*fields: T.StructField | tuple[str, str]) -> T.StructType:
    return T.StructType(
        [f if isinstance(f, T.StructField) else T.StructField(f[0], T._parse_datatype_string(f[1])) for f in fields]
    )


def shards(
    batches: Iterator[pa.RecordBatch], text: str, limit: int = SHARD_BYTES, row_bytes: int = 0
) -> Iterator[pa.RecordBatch]:
    """The rows of the batches, joined until their text reaches ``limit`` bytes.

    ``row_bytes`` is what a row counts besides its text, so that empty rows fill a shard too.
    """
    held, size = [], 0
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        start = 0
        for row, length in enumerate((lengths + row_bytes).tolist()):
            if size and size + length > limit:
                held.append(batch.slice(start, row - start))
                yield _joined(held)
                held, size, start = [], 0, row
            size += length
        held.append(batch.slice(start))
    if any(b.num_rows for b in held):
        yield _joined(held)


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all values in a row and the offsets of each (null: empty)."""
    column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64 if wide else np.int32)[
        column.offset : column.offset + len(column) + 1
    ].astype(np.int64)
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def record(schema_: T.StructType, columns: dict) -> pa.RecordBatch:
    """A record batch of the Spark schema's types."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema_)
    return pa.RecordBatch.from_arrays(
        [
            columns[f.name].cast(f.type) if isinstance(columns[f.name], pa.Array) else pa.array(columns[f.name], f.type)
            for f in arrow
        ],
        schema=arrow,
    )




# Rows of one key that one join task should get.
ROWS_PER_TASK = 500_000


def spread_left_join(left: DataFrame, right: DataFrame, key: str, counts: DataFrame, spread: F.Column) -> DataFrame:
    """Left join with ``right`` (unique on ``key``), rows of a hot key spread over several tasks.

    ``counts`` (key, n) says how many left rows a key has. A key of more than
    ``ROWS_PER_TASK`` rows gets one copy of its right row for each so many; the
    list of such keys has at most rows / ``ROWS_PER_TASK`` entries, and Spark
    picks its join by its measured size. ``spread`` deals a hot key's rows out.
    """
    hot = counts.where(F.col("n") > ROWS_PER_TASK).select(
        key, (F.lit(1) + F.floor(F.col("n") / ROWS_PER_TASK)).cast("int").alias("_copies")
    )
    dealt = left.join(hot, key, "left").withColumn(
        "_part", F.when(F.col("_copies").isNull(), 0).otherwise(F.pmod(spread, F.col("_copies"))).cast("int")
    )
    copies = right.join(hot, key, "left").withColumn(
        "_part", F.explode(F.sequence(F.lit(0), F.coalesce("_copies", F.lit(1)) - 1))
    )
    return dealt.drop("_copies").join(copies.drop("_copies"), [key, "_part"], "left").drop("_part")
