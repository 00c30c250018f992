"""Dense surrogate keys without a single-task sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.sources.steps import written

# Rows that one range of the order column should hold.
ROWS_PER_RANGE = 1 << 20
# A place is the number of the range above this bit and the row within it below.
_RANGE_BIT = 33


def ranged(df: DataFrame, order_col: str, ranges: int | None = None) -> DataFrame:
    """The rows cut into ranges of ``order_col`` and written in order, each with its ``_place``.

    Spark samples the column once for the cuts and moves every row once to its
    range, which it finds by halving. Rows without a value come first, told
    apart by a hash of the row, so that many of them fill ranges of their own
    instead of one. The rows are written: a place once given stays.
    """
    ranges = ranges or 1 + df.count() // ROWS_PER_RANGE
    apart = F.when(F.col(order_col).isNull(), F.xxhash64(*df.columns))
    order = [F.col(order_col).asc_nulls_first(), apart.asc_nulls_first()]
    cut = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    return written(cut.withColumn("_place", F.monotonically_increasing_id()), "ranged")


def dense_key(df: DataFrame, order_col: str, name: str, start: int = 1, ranges: int | None = None) -> DataFrame:
    """Number the rows ``start, start+1, ...`` in the order of a unique column.

    A row's number is its position in its range plus the sizes of the ranges
    before it: one short list, a row for each ``ROWS_PER_RANGE``, hence the
    broadcast and the window over all of it. The cuts only balance the work;
    the numbering is the same whatever the ranges, the partitioning or the
    number of retries.
    """
    placed = ranged(df, order_col, ranges)
    number = F.shiftrightunsigned("_place", _RANGE_BIT)
    sizes = placed.groupBy(number.alias("_range")).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    position = F.col("_place").bitwiseAND((1 << _RANGE_BIT) - 1)
    return placed.withColumn("_range", number).join(F.broadcast(offsets), "_range").select(
        (F.lit(start) + F.col("_offset") + position).cast("bigint").alias(name), *df.columns
    )
