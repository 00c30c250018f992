"""Sets of integer keys as bits: membership tests and distinct counts that move no fact row.

Keys are dense by construction, so 64 of them share a word. Words are folded by
``bit_or``, a fixed-width sum that is combined in every map task.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.sources.steps import written

# A bucket holds 512 words, 32 768 keys, 4 KB.
_WORDS = 512
_BUCKET_BIT, _WORD_BIT = 15, 6
# Buckets of a set that is broadcast: 64 MB at most, half a billion dense keys.
MAX_BUCKETS = 1 << 14


class KeySet(NamedTuple):
    """(``bucket``, ``full``, ``words``) of a set of keys, and whether it is small enough to be broadcast."""

    frame: DataFrame
    small: bool


def _bits(key: Column) -> Column:
    """The key's bit within its word."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), key.bitwiseAND(63).cast("int"))


def key_set(members: DataFrame, key: str) -> KeySet:
    """The keys of a dimension; a bucket without gap needs no words. NULL is no key.

    Written, so that all tests of a dimension share one build and the size is known.
    """
    k = F.col(key).cast("bigint")
    words = (
        members.where(k.isNotNull())
        .groupBy(
            F.shiftright(k, _BUCKET_BIT).alias("bucket"),
            F.shiftright(k.bitwiseAND((1 << _BUCKET_BIT) - 1), _WORD_BIT).cast("int").alias("word"),
        )
        .agg(F.bit_or(_bits(k)).alias("bits"))
    )
    buckets = words.groupBy("bucket").agg(
        (F.count_if(F.col("bits") == -1) == _WORDS).alias("full"),
        F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("words"),
    )
    listed = F.transform(F.sequence(F.lit(0), F.lit(_WORDS - 1)), lambda i: F.coalesce(F.try_element_at("words", i), F.lit(0)))
    frame = written(buckets.select("bucket", "full", F.when(~F.col("full"), listed).alias("words")), "keys")
    return KeySet(frame, frame.count() <= MAX_BUCKETS)


def with_membership(df: DataFrame, column: str, keys: KeySet, flag: str) -> DataFrame:
    """``flag``: whether the set holds the row's key. Rows stay where they are; NULL is in no set."""
    k = F.col(column).cast("bigint")
    names = {c: f"_{flag}_{c}" for c in keys.frame.columns}
    side = keys.frame.select(*[F.col(c).alias(n) for c, n in names.items()])
    word = F.shiftright(k.bitwiseAND((1 << _BUCKET_BIT) - 1), _WORD_BIT).cast("int") + 1
    held = F.col(names["full"]) | (F.getbit(F.element_at(names["words"], word), k.bitwiseAND(63).cast("int")) == 1)
    joined = df.join(F.broadcast(side), F.shiftright(k, _BUCKET_BIT) == F.col(names["bucket"]), "left")
    return joined.withColumn(flag, F.coalesce(held, F.lit(False))).drop(*names.values())


def totals_and_distincts(df: DataFrame, totals: dict[str, Column], distincts: dict[str, str]) -> DataFrame:
    """One row: sums of ``totals`` and exact distinct counts of columns, in one scan of ``df``.

    Whole numbers and dates are folded into words of 64; other columns are
    grouped by value and should be short lists. A row gives one small cell per
    column, combined in the map task; NULL is not counted. Sums of nothing are NULL.
    """
    kinds = {name: df.schema[c].dataType.typeName() for name, c in distincts.items()}
    cells = []
    for i, (name, column) in enumerate(distincts.items()):
        if kinds[name] in ("byte", "short", "integer", "long", "date"):
            k = (F.unix_date(column) if kinds[name] == "date" else F.col(column)).cast("bigint")
            cell = _cell(F.shiftright(k, _WORD_BIT), _bits(k), None)
        else:
            cell = _cell(None, None, F.col(column).cast("string"))
        # The first cell carries the totals, whose types decide those of the others.
        carried = [v if i == 0 else F.lit(None) for v in totals.values()]
        cells.append(F.struct(F.lit(i).alias("c"), *cell, *[v.alias(n) for n, v in zip(totals, carried, strict=True)]))
    stacked = df.select(F.inline(F.array(*cells)))
    folded = stacked.groupBy("c", "word", "text").agg(
        F.bit_or("bits").alias("bits"), *[F.sum(n).alias(n) for n in totals]
    )
    counts = [
        F.coalesce(
            F.sum(F.when(F.col("c") == i, F.coalesce(F.bit_count("bits"), F.col("text").isNotNull().cast("int")))), F.lit(0)
        ).cast("bigint").alias(name)
        for i, name in enumerate(distincts)
    ]
    return folded.agg(*[F.sum(n).alias(n) for n in totals], *counts)


def _cell(word: Column | None, bits: Column | None, text: Column | None) -> list[Column]:
    empty = F.lit(None)
    return [
        (empty if word is None else word).cast("bigint").alias("word"),
        (empty if bits is None else bits).cast("bigint").alias("bits"),
        (empty if text is None else text).cast("string").alias("text"),
    ]
