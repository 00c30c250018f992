"""Deduplication, dense keys, lookups and grouped checks, including hot keys."""

import pytest
from pyspark.sql import functions as F

from ledgerflow.operators import bitmaps, grouping, lookup, skew
from ledgerflow.operators.dedup import first_by, occurrence_key
from ledgerflow.operators.keys import dense_key, ranged
from ledgerflow.operators.skew import find_skew


def dedup(df):
    return first_by(df, occurrence_key(F.col("id"), F.col("ligne")), [F.col("ligne"), F.col("v")])


def test_first_line_is_kept(spark):
    lines = [("a", 9, "x"), ("a", 5, "y"), (None, 7, "p"), (None, 8, "q"), (None, None, "r"), (None, None, "s")]
    kept = dedup(spark.createDataFrame(lines, "id string, ligne int, v string")).collect()
    assert sorted((r.id or "", r.ligne or 0, r.v) for r in kept) == [
        ("", 0, "r"), ("", 7, "p"), ("", 8, "q"), ("a", 5, "y"),
    ]


def test_missing_line_number_comes_first(spark):
    lines = [("a", 5, "y"), ("a", None, "x")]
    assert dedup(spark.createDataFrame(lines, "id string, ligne int, v string")).first().v == "x"


def test_dedup_limits_rows_before_the_shuffle(spark):
    """A hot identifier reaches the shuffle as one row per task."""
    df = spark.range(1000).selectExpr("if(id % 3 = 0, 'hot', string(id)) as id", "int(id) as ligne", "'v' as v")
    plan = dedup(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert dedup(df).count() == 1000 - 334 + 1


@pytest.mark.parametrize("buckets", [2, 7, 256])
@pytest.mark.parametrize("partitions", ["1", "5"])
def test_dense_key_is_the_sorted_position(spark, buckets, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        df = spark.range(500).selectExpr("concat('C', lpad(string(id * 7919 % 100000), 6, '0')) as code", "id")
        rows = dense_key(df.repartition(6), "code", "k", ranges=buckets).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert [r.code for r in sorted(rows, key=lambda r: r.k)] == sorted(r.code for r in rows)
    assert sorted(r.k for r in rows) == list(range(1, 501))


def test_dense_key_of_an_empty_table(spark):
    assert dense_key(spark.range(0).selectExpr("string(id) as code"), "code", "k").count() == 0


def test_dense_key_spreads_rows_without_value(spark):
    """Half the rows without value: they come first, in ranges of about the size of the others."""
    df = spark.range(4000).selectExpr("if(id % 2 = 0, null, lpad(string(id), 5, '0')) as code", "id")
    sizes = ranged(df, "code", 8).groupBy(F.expr("_place >> 33")).count().collect()
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < 1000
    rows = dense_key(df, "code", "k", start=10, ranges=8).collect()
    assert sorted(r.k for r in rows) == list(range(10, 4010))
    assert {r.k for r in rows if r.code is None} == set(range(10, 2010))
    given = sorted((r for r in rows if r.code), key=lambda r: r.k)
    assert [r.code for r in given] == sorted(r.code for r in given)


def test_dense_key_reads_the_input_once_for_cuts_and_once_for_numbers(spark, tmp_path):
    """The rows move once, found their range without a list of cuts, and the offsets are the only broadcast."""
    spark.range(1000).selectExpr("string(id) as code", "id").write.parquet(str(tmp_path / "in"))
    df = spark.read.parquet(str(tmp_path / "in"))
    plan = dense_key(df, "code", "k", ranges=4)._jdf.queryExecution().executedPlan().toString()
    assert str(tmp_path / "in") not in plan and "step-ranged" in plan
    assert "cuts" not in plan and "SortMergeJoin" not in plan and plan.count("BroadcastExchange") == 1


def test_split_join_equals_plain_join(spark):
    """A third of the rows on one key, a third without key, the rest spread; some keys unknown."""
    left = spark.range(9000).selectExpr(
        "id", "case id % 3 when 0 then 'hot' when 1 then null else string(id % 50) end as fk"
    )
    right = spark.range(40).selectExpr("string(id) as code", "id as found").unionByName(
        spark.createDataFrame([("hot", -1)], "code string, found bigint")
    )
    hot = lookup.hot_keys(left, F.col("fk"), min_rows=1000, rows_per_split=400)
    assert [tuple(r) for r in hot.collect()] == [("hot", 8)]
    split = lookup.split_left_join(left, right, F.col("fk"), "code", ["id"], hot)
    plain = left.join(right.withColumnRenamed("code", "fk"), "fk", "left")
    assert sorted(map(tuple, split.select("id", "found").collect()), key=str) == sorted(
        map(tuple, plain.select("id", "found").collect()), key=str
    )


def test_skew_of_all_lookups_from_one_pass(spark):
    """Every key of at least the limit is found with its exact rows; tasks hold different shares of it."""
    rows = spark.range(60_000).repartition(16).selectExpr(
        "case when id < 20000 then null when id % 5 = 0 then 'hot' else string(id) end as a",
        "cast(case when id % 60 = 1 then 7 when id % 64 = 2 then 8 else id + 1000000 end as bigint) as b",
        "id as c",
    )
    found = find_skew(rows, {n: F.col(n) for n in "abc"}, min_rows=900, rows_per_split=400)
    assert [tuple(r) for r in found["a"].values.collect()] == [("hot", 1 + 8000 // 400)] and found["a"].nulls
    b = {r[0]: r.n for r in rows.where("b < 1000").groupBy("b").agg(F.count("*").alias("n")).collect()}
    assert {tuple(r) for r in found["b"].values.collect()} == {(k, 1 + n // 400) for k, n in b.items() if n >= 900}
    assert found["b"].values.schema["_hot"].dataType.simpleString() == "bigint" and not found["b"].nulls
    assert found["c"].none and find_skew(rows, {"a": F.col("a")})["a"].none


def test_summaries_miss_no_key_within_their_bound(spark):
    """No key of more than 7 n / items rows is missing; estimates stay within half of that; one pass, no key list shuffled."""
    items, n = 256, 40_000
    rows = spark.range(n).repartition(8).selectExpr("if(id % 3 = 0, pmod(hash(id), 25), id) as k", "id % 11 as m")
    exact = {r.k: r["count"] for r in rows.groupBy("k").count().collect()}
    frame = skew.candidates(rows, {"k": F.col("k"), "m": F.col("m")}, items)
    found = frame.first()
    listed = {r["item"]: r["count"] for r in found.k}
    bound = 7 * n / items
    assert {k for k, c in exact.items() if c > bound} <= set(listed) and len(listed) <= items
    assert all(abs(c - exact[k]) <= bound / 2 for k, c in listed.items())
    assert len(found.m) == 11 and frame._jdf.queryExecution().executedPlan().toString().count("Range (") == 1


def test_plain_join_without_skew(spark):
    left = spark.range(100).selectExpr("id", "if(id % 4 = 0, null, string(id % 7)) as fk")
    right = spark.createDataFrame([("1", 10), ("2", 20)], "code string, found int")
    plain = lookup.split_left_join(left, right, F.col("fk"), "code", ["id"], skew.NO_SKEW)
    nulls = lookup.split_left_join(left, right, F.col("fk"), "code", ["id"], skew.Skew(None, True))
    assert "_split" not in plain._jdf.queryExecution().optimizedPlan().toString()
    assert plain.columns == nulls.columns and sorted(map(str, plain.collect())) == sorted(map(str, nulls.collect()))


def test_hot_key_is_spread_over_join_groups(spark):
    left = spark.range(8000).selectExpr("id", "'hot' as fk")
    right = spark.createDataFrame([("hot", 1)], "code string, found int")
    hot = lookup.hot_keys(left, F.col("fk"), min_rows=10, rows_per_split=100)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = lookup.split_left_join(left, right, F.col("fk"), "code", ["id"], hot)
        sizes = [r[1] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 8000 and len(sizes) == 4 and max(sizes) < 4000


def test_rows_without_key_are_spread(spark):
    left = spark.range(8000).selectExpr("id", "cast(null as string) as fk")
    right = spark.createDataFrame([("a", 1)], "code string, found int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = lookup.split_left_join(left, right, F.col("fk"), "code", ["id"])
        sizes = [r[1] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 8000 and len(sizes) == 4 and max(sizes) < 2500


def test_orphan_rows_with_a_hot_orphan(spark, monkeypatch):
    monkeypatch.setattr(lookup, "HOT_MIN_ROWS", 5)
    df = spark.range(300).selectExpr("id", "case id % 3 when 0 then ' a9 ' when 1 then '' else 'a1' end as fk")
    ref = spark.createDataFrame([("A1",)], "code string")
    assert lookup.orphan_rows(df, "fk", ref, "code").where("id % 3 = 0").count() == 100
    assert lookup.orphan_rows(df, "fk", ref, "code").count() == 100


def test_null_orphans_keep_every_row(spark):
    df = spark.createDataFrame([(1, "a1"), (2, "A2"), (3, None), (4, "A9")], "n int, fk string")
    refs = spark.createDataFrame([(" A1",), ("a2 ",), ("A2",), (None,), ("",)], "code string")
    out = lookup.null_orphans(df, {"fk": (refs, "code")})
    assert sorted((r.n, r.fk) for r in out.select("n", "fk").collect()) == [(1, "a1"), (2, "A2"), (3, None), (4, None)]


def test_resolve_key_never_matches_the_unknown_member(spark):
    dim = spark.createDataFrame([(0, "INCONNU"), (1, "A1")], "k int, code string")
    df = spark.createDataFrame([("A1",), ("INCONNU",), (None,), ("A999",)], "fk string")
    out = lookup.resolve_key(df, F.col("fk"), dim, "code", "k", "key").collect()
    assert sorted((r.fk or "", r.key) for r in out) == [("", 0), ("A1", 1), ("A999", 0), ("INCONNU", 0)]


@pytest.mark.parametrize("buckets", [1 << 14, 0])
@pytest.mark.parametrize("least", [1, 500_000])
def test_any_orphan_counts_a_row_once(spark, monkeypatch, least, buckets):
    """By bitmap, and by value for a dimension beyond the bound of a bitmap."""
    monkeypatch.setattr(bitmaps, "MAX_BUCKETS", buckets)
    monkeypatch.setattr(lookup, "HOT_MIN_ROWS", least)
    rows = spark.createDataFrame([(1, 1), (1, 9), (9, 1), (9, 9), (None, 1)], "a int, b int")
    dim = spark.createDataFrame([(1,)], "k int")
    count = lambda fks: lookup.any_orphan(rows, fks, "n").first().n
    assert count([("a", dim, "k"), ("b", dim, "k")]) == 4
    assert count([("b", dim, "k")]) == 2
    whole = spark.createDataFrame([(1,), (9,)], "k int")
    assert count([("b", whole, "k")]) == 0


def test_membership_in_a_key_set(spark):
    """Gaps, full buckets, negative keys, both ends of words and buckets, NULL, and no members at all."""
    held = [*range(0, 32768), 32768, 40000, 65535, -1, -32769, 2**40, 2**40 + 63]
    members = spark.createDataFrame([(k,) for k in [*held, None, 5]], "k bigint")
    probes = [None, -2, -1, 0, 63, 64, 32767, 32768, 32769, 40000, 65535, 65536, -32768, -32769, -32770, 2**40, 2**40 + 62, 2**40 + 63]
    rows = spark.createDataFrame([(p,) for p in probes], "fk bigint")
    keys = bitmaps.key_set(members, "k")
    assert keys.small and keys.frame.where("full").count() == 1
    found = bitmaps.with_membership(rows, "fk", keys, "known").collect()
    assert {r.fk: r.known for r in found} == {p: p in held for p in probes} and len(found) == len(probes)
    none = bitmaps.key_set(members.where("k = 7 and k = 8"), "k")
    assert not any(r.known for r in bitmaps.with_membership(rows, "fk", none, "known").collect())


def test_totals_and_distincts(spark):
    rows = spark.range(5000).selectExpr(
        "id % 7 as a", "cast(id % 1000 - 500 as int) as b", "if(id % 3 = 0, null, string(id % 11)) as c",
        "date_add(date '1969-12-20', cast(id % 40 as int)) as d", "cast(id as decimal(10,2)) as amount",
    )
    distincts = {"da": "a", "db": "b", "dc": "c", "dd": "d"}
    made = bitmaps.totals_and_distincts(rows, {"total": F.col("amount"), "n": F.lit(1)}, distincts).first()
    plain = rows.agg(F.sum("amount"), F.count("*"), *[F.countDistinct(c) for c in distincts.values()]).first()
    assert tuple(made) == tuple(plain)
    none = bitmaps.totals_and_distincts(rows.where("a > 9"), {"total": F.col("amount")}, distincts).first()
    assert tuple(none) == (None, 0, 0, 0, 0)


def test_unmatched_counts_reports_zero(spark):
    rows = spark.createDataFrame([("x", "p"), ("x", None), ("y", "q")], "a string, b string")
    members = {"A": spark.createDataFrame([("x",), ("y",)], "c string"), "B": spark.createDataFrame([("p",)], "c string")}
    lookups = [lookup.Lookup("a", "A", "a"), lookup.Lookup("b", "B", "b")]
    got = {r.cle: (r.valeurs, r.lignes) for r in lookup.unmatched_counts([(rows, lookups)], members).collect()}
    assert got == {"a": (0, 0), "b": (2, 2)}


def test_duplicates_and_surplus(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), (None,), (None,)], "k string")
    summary = grouping.duplicate_summary(df, {"k": F.col("k")}).first()
    assert (summary.cles_dupliquees, summary.lignes_en_trop) == (1, 2)
    assert {r.k for r in grouping.broken_keys(df, ["k"]).collect()} == {"a", None}


def test_coverage_gaps(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "m string, x int")
    gaps = grouping.coverage_gaps(df, "m", "x", "seen", "wanted").collect()
    assert [(r.m, r.seen, r.wanted) for r in gaps] == [("b", 1, 2)]
