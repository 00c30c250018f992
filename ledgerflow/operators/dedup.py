"""First-occurrence deduplication."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.sources.steps import written

_RANK = "_rang"
# Hashes of repeated keys up to which their list is broadcast (some 100 MB).
LISTED_REPEATS = 2_000_000


def occurrence_key(key: Column, line: Column, null_prefix: str = "SANS_ID_") -> Column:
    """Rows without an identifier are told apart by their source line."""
    return F.coalesce(
        key, F.concat(F.lit(null_prefix), F.coalesce(line.cast("string"), F.lit("")))
    )


def first_by(df: DataFrame, key: Column, order: list[Column]) -> DataFrame:
    """Keep the first row per key in the given order.

    ``rank == 1`` lets the engine keep one row per key in every map task
    before the shuffle, so an identifier that holds a large share of all
    lines arrives as one row per task. Give a total order: a retried task
    must pick the same row.
    """
    ranked = df.withColumn(_RANK, F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return ranked.where(F.col(_RANK) == 1).drop(_RANK)


def first_of_lines(
    lines: DataFrame, line_key: Column, prepare: Callable[[DataFrame], DataFrame], key: Column, order: list[Column]
) -> DataFrame:
    """``first_by`` of the prepared lines, in which only lines of a repeated key are sorted and moved.

    ``line_key`` is ``key`` as read from an unprepared line. Its hashes are
    counted first; a key whose hash comes once is its own first row. Two keys of
    one hash only send both to the sort, which compares the keys. Where more
    keys repeat than a list should hold, all lines are sorted.
    """
    hashed = F.xxhash64(line_key)
    counts = lines.groupBy(hashed.alias("_hash")).agg(F.count(F.lit(1)).alias("_lines"))
    repeated = written(counts.where("_lines > 1").select("_hash"), "repeated")
    if repeated.count() > LISTED_REPEATS:
        return first_by(prepare(lines), key, order)
    listed, same = F.broadcast(repeated), hashed == F.col("_hash")
    once, more = (prepare(lines.join(listed, same, how)) for how in ("left_anti", "left_semi"))
    return once.unionByName(first_by(more, key, order))
