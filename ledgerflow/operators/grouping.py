"""Grouped checks: duplicates, key preconditions and coverage of a grid."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COUNT = "nombre_occurrences"


def duplicates(df: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """Keys present more than once, ignoring rows where a part is missing."""
    named = df.select(*[c.alias(n) for n, c in keys.items()])
    return (
        named.dropna(subset=list(keys))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias(COUNT))
        .where(F.col(COUNT) > 1)
    )


def duplicate_summary(df: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """One row: number of repeated keys and of surplus rows."""
    return duplicates(df, keys).agg(
        F.count(F.lit(1)).alias("cles_dupliquees"),
        F.coalesce(F.sum(F.col(COUNT) - 1), F.lit(0)).cast("bigint").alias("lignes_en_trop"),
    )


def broken_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key groups that are NULL or repeated: a valid business key returns no row."""
    missing = reduce(or_, [F.col(k).isNull() for k in keys])
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias(COUNT))
        .where(missing | (F.col(COUNT) > 1))
    )


def coverage_gaps(df: DataFrame, member: str, axis: str, seen: str, wanted: str) -> DataFrame:
    """Members that do not meet every distinct value of ``axis``."""
    pairs = df.select(member, axis).dropna()
    # Counted as rows: distinct counts of two such totals would be merged into a copy of every row for each.
    total = df.select(axis).dropna().distinct().agg(F.count(F.lit(1)).alias(wanted))
    return (
        pairs.groupBy(member)
        .agg(F.countDistinct(axis).alias(seen))
        .select("*", total.scalar().alias(wanted))
        .where(F.col(seen) != F.col(wanted))
    )


def top(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """First ``n`` rows of a report, in a total order so that it repeats."""
    return df.orderBy(*order).limit(n)


def listed(df: DataFrame, n: int | None, *order: Column | str) -> DataFrame:
    """All rows of a list, or its first ``n`` in a total order."""
    return df if n is None else top(df, n, *order)
