"""What the layer builds move: rows that need no partner stay where they are, shuffles follow the rows."""

from pyspark.sql import functions as F

from ledgerflow.functions.text import clean_text
from ledgerflow.operators import dedup, lookup
from ledgerflow.operators.skew import NO_SKEW
from ledgerflow.plans import facts
from ledgerflow.session import partitions_for
from verification import testbed


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_known_identifiers_move_no_row(spark, monkeypatch):
    """A reference too large to broadcast: only values without partner meet the rows, many of them by a join."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(200).selectExpr("id", "case when id % 50 = 7 then null else concat('c', id) end as fk")
        refs = spark.range(190).selectExpr("concat(' C', id) as code").where("code not in (' C5', ' C6')")

        def wanted(i):
            return None if i % 50 == 7 or i in (5, 6) or i >= 190 else f"c{i}"

        for limit, moves in ((100, False), (3, True)):
            monkeypatch.setattr(lookup, "LISTED_ORPHANS", limit)
            out = lookup.null_orphans(df, {"fk": (refs, "code")}, {"fk": NO_SKEW}, ["id"])
            assert ("Exchange hashpartitioning" in plan(out)) is moves
            assert {r.id: r.fk for r in out.collect()} == {i: wanted(i) for i in range(200)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_only_lines_of_repeated_keys_are_sorted(spark, monkeypatch):
    rows = [(f" k{i} ", str(i), "v") for i in range(50)]
    rows += [("k3", "99", "later"), ("k3", "1", "first"), (None, "7", "a"), ("", "8", "b"), (None, None, "c"), (" ", "x", "d")]
    raw = spark.createDataFrame(rows, "id string, ligne string, v string")

    def typed(lines):
        return lines.select(clean_text(F.col("id")).alias("id"), F.expr("try_cast(ligne as int)").alias("ligne"), "v")

    key, order = dedup.occurrence_key(F.col("id"), F.col("ligne")), [F.col("ligne"), F.col("v")]
    own = dedup.occurrence_key(clean_text(F.col("id")), F.expr("try_cast(ligne as int)"))
    expected = sorted(dedup.first_by(typed(raw), key, order).collect(), key=str)
    for limit in (100, 0):
        monkeypatch.setattr(dedup, "LISTED_REPEATS", limit)
        out = dedup.first_of_lines(raw, own, typed, key, order)
        assert sorted(out.collect(), key=str) == expected
        assert ("Union" in plan(out)) is (limit > 0)
    assert [r.v for r in expected if r.id == "k3"] == ["first"]


def test_partitions_follow_the_rows_and_the_setting_returns(spark):
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert spark.conf.get(name, None) is None
    with partitions_for(spark, 10_000_000) as n:
        assert n == 39 and spark.conf.get(name) == "39"
    with partitions_for(spark, 10) as n:
        assert n == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert spark.conf.get(name, None) is None


def test_instalments_are_dealt_out_by_their_number(spark, monkeypatch):
    lines = spark.range(900).selectExpr("id div 3 as l_orderkey", "cast(id % 2 as int) as l_linenumber", "id as v")
    assert testbed.instalments_together(lines) is lines
    monkeypatch.setattr(testbed, "LINES_PER_TASK", 100)
    dealt = testbed.instalments_together(lines)
    assert dealt.rdd.getNumPartitions() == 10
    summed = dealt.groupBy("l_orderkey", "l_linenumber").agg(F.sum("v").alias("v"))
    assert plan(summed).count("Exchange") == 1
    assert sorted(summed.collect()) == sorted(lines.groupBy("l_orderkey", "l_linenumber").agg(F.sum("v").alias("v")).collect())


def test_derived_columns_are_made_after_the_move(golden):
    name = "fact_remboursements"
    fact = facts.JOBS[name](golden.staging, golden.dims)
    moved = facts.by_month(fact, facts.MAIN_DATES[name], facts.derived(name))
    assert moved.columns == [*fact.columns, facts.MONTH] and moved.drop(facts.MONTH).schema == fact.schema
    tree = moved._jdf.queryExecution().optimizedPlan().toString()
    below = tree[tree.index("RebalancePartitions"):]
    assert "montant_non_paye" in tree and "montant_non_paye" not in below
    assert moved.drop(facts.MONTH).exceptAll(fact).isEmpty()
