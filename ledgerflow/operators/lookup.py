"""Reference lookups that stay correct and balanced when keys are hot or missing."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.predicates import any_of
from ledgerflow.functions.rules import key_or_unknown
from ledgerflow.functions.text import reference_key
from ledgerflow.operators.bitmaps import KeySet, key_set, with_membership
from ledgerflow.operators.skew import HOT_MIN_ROWS, ROWS_PER_SPLIT, Skew, find_skew
from ledgerflow.sources.steps import written

# There are at most rows / HOT_MIN_ROWS hot keys, all of them split: half a million (20 MB)
# for 10**12 rows, so the list is broadcast and the large side keeps its one shuffle.
# Join groups for rows without a key: they need no partner, hence no copies.
NULL_SPLITS = 1 << 16

# Identifiers without reference up to which their list is broadcast (some 10 MB), whatever its plan is estimated at.
LISTED_ORPHANS = 200_000

# Column, dimension, key of the dimension.
ForeignKey = tuple[str, DataFrame, str]


class Lookup(NamedTuple):
    """One reference of a frame: its label, its member list and its identifier (SQL)."""

    label: str
    members: str
    identifier: str


def hot_keys(
    df: DataFrame,
    key: Column,
    min_rows: int = HOT_MIN_ROWS,
    rows_per_split: int = ROWS_PER_SPLIT,
) -> DataFrame:
    """All frequent keys (``_hot``) and the groups to spread them over (``_splits``).

    At most rows / ``min_rows`` keys, hence safe to broadcast. The count is
    combined map-side: finding them is not itself skewed.
    """
    per_value = (
        df.select(key.alias("_hot")).where("_hot is not null").groupBy("_hot").agg(F.expr("count(1) as _rows"))
    )
    return _split_by_size(per_value, min_rows, rows_per_split)


def _split_by_size(per_value: DataFrame, min_rows: int, rows_per_split: int) -> DataFrame:
    return per_value.where(f"_rows >= {min_rows}").selectExpr(
        "_hot", f"cast(1 + _rows div {rows_per_split} as int) as _splits"
    )


def split_left_join(
    left: DataFrame,
    right: DataFrame,
    left_key: Column,
    right_key: str,
    spread_by: list[str],
    hot: DataFrame | Skew | None = None,
) -> DataFrame:
    """Left join against a reference unique on ``right_key``; ``right_key`` is dropped.

    ``hot`` is what is known of the left keys; where neither a value nor the
    missing key has many rows this is a plain join.

    Rows of a hot key are spread over as many join groups as its size asks
    for, by a hash of ``spread_by``, and only the reference row of that key is
    copied once per group; rows without a key are spread without copies.
    Every other row joins as usual, so nothing is capped. The spread is a
    function of the row, hence stable under retries.
    """
    if isinstance(hot, Skew):
        if hot.none:
            return left.withColumn("_key", left_key).join(right, F.col("_key") == F.col(right_key), "left").drop("_key", right_key)
        kind = right.schema[right_key].dataType.simpleString()
        hot = left.sparkSession.createDataFrame([], f"_hot {kind}, _splits int") if hot.values is None else hot.values
    hot = F.broadcast(hot_keys(left, left_key) if hot is None else hot)
    spread = F.xxhash64(*spread_by)
    tagged = (
        left.withColumns({"_key": left_key, "_spread": spread})
        .join(hot, F.col("_key") == F.col("_hot"), "left")
        .withColumn(
            "_split",
            F.expr(
                f"cast(case when _key is null then pmod(_spread, {NULL_SPLITS})"
                " when _hot is not null then pmod(_spread, _splits) else 0 end as int)"
            ),
        )
        .drop("_hot", "_splits", "_spread")
    )
    reference = (
        right.withColumnRenamed(right_key, "_key")
        .join(hot, F.col("_key") == F.col("_hot"), "left")
        .withColumn("_split", F.expr("explode(sequence(0, coalesce(_splits, 1) - 1))"))
        .drop("_hot", "_splits")
    )
    return tagged.join(reference, ["_key", "_split"], "left").drop("_key", "_split")


def reference_keys(ref: DataFrame, column: str, name: str = "_ref") -> DataFrame:
    """Distinct comparable identifiers of a raw reference table."""
    key = reference_key(F.col(column)).alias(name)
    return ref.select(key).where(F.col(name).isNotNull()).distinct()


def null_orphans(
    df: DataFrame,
    references: dict[str, tuple[DataFrame, str]],
    large: dict[str, DataFrame | Skew] | None = None,
    spread_by: list[str] | None = None,
    values: DataFrame | None = None,
) -> DataFrame:
    """Blank identifiers that no reference row carries; rows are always kept.

    ``large`` maps a column to its hot keys and says that its reference grows
    with the data: the column's distinct values meet the reference alone, and
    the rows meet only the values that it lacks. A short list of those moves no
    row; a long one is joined by the split join. ``values`` is a cheaper frame
    that holds at least the identifiers of ``df``. The engine picks the join
    strategy of the other columns from the reference's size.
    """
    large = large or {}
    for column, (ref, ref_column) in references.items():
        own = F.upper(F.col(column))
        if column in large:
            keys = ref.select(reference_key(F.col(ref_column)).alias("_ref")).where("_ref is not null")
            missing = unmatched_values(df if values is None else values, own, keys, "_ref").where("_fk is not null")
            listed = written(missing.select("_fk"), "orphans")
            flagged = listed.withColumn("_missing", F.lit(True))
            if listed.count() <= LISTED_ORPHANS:
                joined = df.join(F.broadcast(flagged), own == F.col("_fk"), "left").drop("_fk")
            else:
                joined = split_left_join(df, flagged, own, "_fk", spread_by, large[column])
            df = joined.withColumn(column, F.when(F.col("_missing").isNull(), F.col(column))).drop("_missing")
        else:
            keys = reference_keys(ref, ref_column).withColumn("_known", F.lit(True))
            joined = df.join(keys, own == F.col("_ref"), "left").drop("_ref")
            df = joined.withColumn(column, F.when(F.col("_known"), F.col(column))).drop("_known")
    return df


def resolve_key(
    df: DataFrame,
    fk: Column,
    dim: DataFrame,
    id_col: str,
    key_col: str,
    alias: str,
    *,
    broadcast: bool = False,
    hot: DataFrame | Skew | None = None,
    spread_by: list[str] | None = None,
) -> DataFrame:
    """Add ``alias``: the dimension key of ``fk``, or 0 when nothing matches.

    The unknown member is left out of the lookup so that its business key
    never matches by accident. ``broadcast`` is for dimensions whose size is
    bounded by construction (the calendar); ``spread_by`` selects the split
    join for dimensions that grow with the data. Text identifiers meet in
    their comparable form on both sides; of members that only differ in it,
    the one with the least key answers.
    """
    lookup = dim.where(F.col(key_col) != 0).select(
        F.col(id_col).alias("_id"), F.col(key_col).alias("_found")
    )
    if dim.schema[id_col].dataType.simpleString() == "string":
        fk = reference_key(fk)
        lookup = lookup.groupBy(reference_key(F.col("_id")).alias("_id")).agg(F.min("_found").alias("_found"))
        hot = _comparable(hot)
    if spread_by:
        joined = split_left_join(df, lookup, fk, "_id", spread_by, hot)
    else:
        side = F.broadcast(lookup) if broadcast else lookup
        joined = df.join(side, fk == F.col("_id"), "left").drop("_id")
    return joined.withColumn(alias, key_or_unknown(F.col("_found"))).drop("_found")


def _comparable(hot: DataFrame | Skew | None) -> DataFrame | Skew | None:
    """Hot keys in the form in which text identifiers meet."""
    if isinstance(hot, Skew):
        return hot._replace(values=_comparable(hot.values))
    if hot is None:
        return None
    # Values of one form share its rows.
    return hot.groupBy(reference_key(F.col("_hot")).alias("_hot")).agg(F.sum("_splits").cast("int").alias("_splits"))


def unmatched_values(df: DataFrame, fk: Column, ref: DataFrame, ref_col: str) -> DataFrame:
    """Key values without a partner (``_fk``) and the rows that carry them (``_rows``).

    Counted per value first, map-side, so the anti join sees each value once
    however many rows share it. NULL is a value without a partner.
    """
    per_value = df.groupBy(fk.alias("_fk")).agg(F.expr("count(1) as _rows"))
    return per_value.join(ref.selectExpr(f"{ref_col} as _fk"), "_fk", "left_anti")


def unmatched_counts(
    sources: list[tuple[DataFrame, list[Lookup]]], members: dict[str, DataFrame]
) -> DataFrame:
    """``(cle, valeurs, lignes)`` for many lookups at once: values and rows without a partner.

    ``sources`` lists frames with their lookups (label, member list, SQL
    expression of the identifier); ``members`` maps a member list to a
    one-column frame. The identifiers of a frame are the grouping sets of one
    pass, each in its own type, counted per value map-side; all of them meet
    all member lists in a single join. Lookups without any unmatched row are
    reported with 0.
    """
    labels = [lookup.label for _, lookups in sources for lookup in lookups]
    spark = sources[0][0].sparkSession
    numbered = spark.createDataFrame(list(enumerate(labels)), "_n int, cle string")
    lists = list(members)
    # One value column per type of identifier; a row fills that of its own type.
    kinds = sorted({f.dataType.simpleString() for frame in members.values() for f in frame.schema.fields[:1]})

    def values(column: Column, kind: str) -> list[Column]:
        return [(column if k == kind else F.lit(None)).cast(k).alias(f"_{k}") for k in kinds]

    position = 0
    taken = []
    for frame, lookups in sources:
        keys = [f"_k{i}" for i in range(len(lookups))]
        named = frame.select(*[F.expr(x.identifier).alias(k) for k, x in zip(keys, lookups, strict=True)])
        # A row of one grouping set holds that key; the sets before it are told by their grouping flag.
        grouped = named.groupingSets([[F.col(k)] for k in keys], *[F.col(k) for k in keys]).agg(
            F.count(F.lit(1)).alias("_rows"), *[F.grouping(k).alias(f"_other{k}") for k in keys]
        )
        cells = [
            F.struct(
                F.lit(position + i).alias("_n"),
                F.lit(lists.index(x.members)).alias("_list"),
                *values(F.col(k), members[x.members].schema[0].dataType.simpleString()),
            )
            for i, (k, x) in enumerate(zip(keys, lookups, strict=True))
        ]
        picked = F.coalesce(*[F.when(F.col(f"_other{k}") == 0, cell) for k, cell in zip(keys, cells, strict=True)])
        taken.append(grouped.select(picked.alias("_cell"), "_rows").select("_cell.*", "_rows"))
        position += len(lookups)
    known = reduce(
        DataFrame.union,
        [
            frame.select(F.lit(i).alias("_list"), *values(F.col(f"`{frame.columns[0]}`"), frame.schema[0].dataType.simpleString()))
            for i, frame in enumerate(members.values())
        ],
    )
    per_value = reduce(DataFrame.union, taken).alias("v")
    same = [F.col("v._list") == F.col("k._list"), *[F.col(f"v._{k}").eqNullSafe(F.col(f"k._{k}")) for k in kinds]]
    missing = (
        per_value.join(known.alias("k"), same, "left_anti")
        .groupBy("_n")
        .agg(F.expr("count(1) as _values"), F.expr("sum(_rows) as _rows"))
    )
    return numbered.join(missing, "_n", "left").selectExpr(
        "cle",
        "coalesce(_values, 0L) as valeurs",
        "coalesce(_rows, 0L) as lignes",
    )


def broken_keys(df: DataFrame, fks: list[ForeignKey], name: str, sets: dict[str, KeySet] | None = None) -> DataFrame:
    """One row: rows of ``df`` whose key is absent from its dimension, per key and (``name``) any of them.

    One scan, in which no row moves: the keys of a dimension are a bitmap of a
    checked size. Only the keys of a dimension beyond that size are looked up
    by ``_flag_by_value``. A missing key is broken; a row broken in several
    ways counts once in ``name``. ``sets`` holds bitmaps made before, by key column.
    """
    rows = df.select(*dict.fromkeys(column for column, _, _ in fks))
    flags = {}
    for i, (column, dim, key) in enumerate(fks):
        flag = flags[column] = f"_known{i}"
        keys = sets[key] if sets else key_set(dim, key)
        rows = with_membership(rows, column, keys, flag) if keys.small else _flag_by_value(rows, column, dim, key, flag)
    broken = {column: ~F.col(flag) for column, flag in flags.items()}
    return rows.agg(
        F.count_if(any_of(*broken.values())).alias(name), *[F.count_if(b).alias(column) for column, b in broken.items()]
    )


def _flag_by_value(rows: DataFrame, column: str, dim: DataFrame, key: str, flag: str) -> DataFrame:
    """``flag``: whether the dimension holds the key, by one shuffle; values without partner are split by their count."""
    values = written(unmatched_values(rows, F.col(column), dim, key).where("_fk is not null"), "unmatched")
    hot = _split_by_size(values.withColumnRenamed("_fk", "_hot"), HOT_MIN_ROWS, ROWS_PER_SPLIT)
    listed = values.select("_fk", F.lit(True).alias("_missing"))
    spread = rows.withColumn("_row", F.monotonically_increasing_id())
    joined = split_left_join(spread, listed, F.col(column), "_fk", ["_row"], hot)
    return joined.withColumn(flag, F.col(column).isNotNull() & F.col("_missing").isNull()).drop("_missing", "_row")


def any_orphan(df: DataFrame, fks: list[ForeignKey], name: str) -> DataFrame:
    """One row: rows of ``df`` with at least one key absent from its dimension."""
    return broken_keys(df, fks, name).select(name)


def orphan_rows(df: DataFrame, column: str, ref: DataFrame, ref_column: str) -> DataFrame:
    """Rows whose given identifier is absent from a raw reference table."""
    keys = reference_keys(ref, ref_column).withColumn("_known", F.lit(True))
    own = reference_key(F.col(column))
    given = df.where(own.isNotNull())
    joined = split_left_join(given, keys, own, "_ref", df.columns, find_skew(given, {"_own": own})["_own"])
    return joined.where("_known is null").drop("_known")
