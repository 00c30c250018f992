"""Keys that many rows share, for all lookups of a table from one pass."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.sources.steps import written

# Rows up to which a key is a task like others, and that one join group of a hot key should receive.
HOT_MIN_ROWS = 2_000_000
ROWS_PER_SPLIT = 1_000_000
# A summary of m items misses no key of more than 7 n / m of n rows: twice its largest error.
_ITEMS_PER_HOT_KEY, _LEAST_ITEMS, _MOST_ITEMS = 8, 64, 1_000_000
# Groups in which the tasks' summaries are merged before they meet.
_MERGE_GROUPS = 64


class Skew(NamedTuple):
    """The hot keys of a lookup (``_hot``, ``_splits``), None if there are none, and whether many rows have no key."""

    values: DataFrame | None
    nulls: bool

    @property
    def none(self) -> bool:
        return self.values is None and not self.nulls


NO_SKEW = Skew(None, False)


def candidates(df: DataFrame, keys: dict[str, Column], items: int) -> DataFrame:
    """One row: per key its frequent items (value, estimated rows) and ``nulls_<key>``, by Misra-Gries summaries.

    Every task keeps at most ``items`` counters per key, whatever the number of
    distinct keys; summaries are merged in groups, then into one. No key of more
    than 7 rows in ``items`` is missed; estimates are off by half of that at most.
    """
    states = (
        df.select(*[k.alias(n) for n, k in keys.items()])
        .groupBy(F.pmod(F.spark_partition_id(), F.lit(_MERGE_GROUPS)).alias("_group"))
        .agg(
            *[F.expr(f"approx_top_k_accumulate(`{n}`, {items})").alias(n) for n in keys],
            *[F.count_if(F.col(n).isNull()).alias(f"nulls_{n}") for n in keys],
        )
    )
    merged = states.agg(
        *[F.expr(f"approx_top_k_combine(`{n}`, {items})").alias(n) for n in keys],
        *[F.sum(f"nulls_{n}").alias(f"nulls_{n}") for n in keys],
    )
    return merged.select(
        *[F.expr(f"approx_top_k_estimate(`{n}`, {items})").alias(n) for n in keys], *[f"nulls_{n}" for n in keys]
    )


def _listed(key: str, number: int, least: int) -> Column:
    """The items of a key that may have ``least`` rows, as text under the key's number."""
    likely = F.filter(key, lambda x: x["item"].isNotNull() & (2 * x["count"] >= least))
    return F.transform(likely, lambda x: F.struct(F.lit(number).alias("_n"), x["item"].cast("string").alias("_text")))


def find_skew(
    df: DataFrame, keys: dict[str, Column], min_rows: int | None = None, rows_per_split: int | None = None
) -> dict[str, Skew]:
    """All keys of at least ``min_rows`` rows, per lookup; a key is split by its exact number of rows.

    A table of fewer rows has none and is not read. Otherwise one pass finds
    the candidates of all lookups, and only if there are any a second pass counts
    those exactly: at most rows / ``min_rows`` values per lookup, hence the
    broadcasts. Beyond 2 * 10**11 rows the limit grows with the table, so that
    a summary stays within ``_MOST_ITEMS`` counters.
    """
    rows_per_split = rows_per_split or ROWS_PER_SPLIT
    total, least = df.count(), min_rows or HOT_MIN_ROWS
    if total < least:
        return dict.fromkeys(keys, NO_SKEW)
    least = max(least, _ITEMS_PER_HOT_KEY * total // _MOST_ITEMS)
    items = max(_LEAST_ITEMS, _ITEMS_PER_HOT_KEY * total // least)
    found = written(candidates(df, keys, items), "frequent")
    names = list(keys)
    listed = written(found.select(F.inline(F.concat(*[_listed(n, i, least) for i, n in enumerate(names)]))), "candidates")
    nulls = found.select(*[(F.col(f"nulls_{n}") >= least).alias(n) for n in names]).first()
    if listed.isEmpty():
        return {n: Skew(None, nulls[n]) for n in names}
    cells = F.array(*[F.struct(F.lit(i).alias("_n"), keys[n].cast("string").alias("_text")) for i, n in enumerate(names)])
    counts = df.select(F.inline(cells)).join(F.broadcast(listed), ["_n", "_text"]).groupBy("_n", "_text").count()
    hot = written(counts.where(F.col("count") >= least), "hot")
    kinds = df.select(*[k.alias(n) for n, k in keys.items()]).schema
    present = {r["_n"] for r in hot.select("_n").distinct().collect()}
    return {
        n: Skew(
            hot.where(F.col("_n") == i).select(
                F.col("_text").cast(kinds[n].dataType).alias("_hot"),
                (F.lit(1) + F.floor(F.col("count") / rows_per_split)).cast("int").alias("_splits"),
            )
            if i in present
            else None,
            nulls[n],
        )
        for i, n in enumerate(names)
    }
