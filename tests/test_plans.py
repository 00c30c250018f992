"""Physical plans: pruning, pushdown, no cross product, no Python in the row path."""

import re

import pytest

from pyspark.sql import functions as F

from ledgerflow.plans import controls, facts, quality, reports, staging, summaries
from ledgerflow.plans import measures as M


def executed(df):
    spark = df.sparkSession
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_report_reads_only_its_columns(golden):
    plan = executed(reports.monthly_revenue(golden.mart))
    schemas = {s.split(" ")[0] for s in re.findall(r"ReadSchema: struct<(.*?)>", plan)}
    read = {frozenset(re.findall(r"(\w+):", s)) for s in schemas}
    assert frozenset({"date_key", "mois_debut"}) in read
    fact = next(columns for columns in read if "frais" in columns)
    assert fact <= {
        "date_key", "frais", "nombre_transactions", "montant_debit", "montant_credit", "montant_signe", "statut",
    }


def test_slicer_reaches_the_scan(golden):
    sliced = reports.transactions_by_channel(golden.mart, {"canal": "TPE"})
    assert "EqualTo(canal,TPE)" in executed(sliced)


@pytest.mark.parametrize("job", ["transactions", "credits", "remboursements"])
def test_staging_stays_in_the_engine(golden, job):
    plan = executed(staging.JOBS[job](golden.raw))
    for forbidden in ("Python", "CartesianProduct", "NestedLoop"):
        assert forbidden not in plan


def test_facts_have_no_product_and_no_python(golden):
    for job in facts.JOBS.values():
        plan = executed(job(golden.staging, golden.dims))
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Python" not in plan


def test_instalments_shuffle_once(golden, spark):
    """With no broadcastable credit table the instalments are exchanged for the credit only."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = executed(facts.fact_remboursements(golden.staging, golden.dims))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin [_key" in plan
    assert sum("Exchange hashpartitioning" in op for op in above(plan, "montant_attendu")) == 1


def test_counted_checks_scan_each_table_once(golden):
    plan = executed(quality.counted(golden.raw, golden.staging, "2026-06-30", ("Q15", "Q16")))
    assert plan.count("FileScan") == 1


def test_controls_have_no_product(golden):
    plan = executed(controls.controls(golden.staging, golden.mart))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def above(plan, marker):
    """Operators above the scan that holds ``marker``, from the scan upwards."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if "FileScan" in line and marker in line)
    depth, found = len(lines[at]) - len(lines[at].lstrip(" :+-*()0123456789")), []
    for line in reversed(lines[:at]):
        column = next((i for i, c in enumerate(line) if c.isalpha()), 0)
        if column < depth:
            depth = column
            found.append(line.strip(" :+-*()0123456789"))
    return found


SLICED = [
    (M.TRANSACTIONS, ["nb_transactions"], ["canal"], {"annee": [2023, 2024]}, "2023"),
    (M.REPAYMENTS, ["nb_impayes"], ["region"], {"annee": 2023, "mois_numero": 5, "categorie_agence": "Urbaine"}, "2023"),
    (M.CREDITS, ["production_credit"], [], {"annee_mois": 202206}, "202206"),
]


@pytest.mark.parametrize("model, names, by, filters, value", SLICED)
def test_calendar_slicer_prunes_files_before_the_sums(golden, model, names, by, filters, value):
    """The months are partition filters, and no row of the fact is exchanged before it is summed."""
    sliced = M.measure(golden.mart, model, names, by, filters)
    plan = executed(sliced)
    scan = next(line for line in plan.splitlines() if "FileScan" in line and facts.MONTH in line)
    partition_filters = scan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert value in partition_filters and facts.MONTH in partition_filters
    chain = above(plan, facts.MONTH)
    first_sum = next(i for i, op in enumerate(chain) if "Aggregate" in op)
    assert not [op for op in chain[:first_sum] if op.startswith("Exchange")]
    files = golden.mart[model.fact].inputFiles()
    months = facts.month_key(model.date_fk(None))
    wanted = golden.mart[model.fact].where(months.isNotNull())
    for condition in M.month_conditions(filters):
        wanted = wanted.where(condition)
    assert 0 < wanted.select(F.input_file_name()).distinct().count() < len(files)


def test_day_slicer_prunes_at_run_time(golden):
    """A calendar attribute that no month decides reaches the files by the join on the month."""
    sliced = M.measure(golden.mart, M.TRANSACTIONS, ["nb_transactions"], ["canal"], {"date_complete": ["2023-05-04"]})
    assert "dynamicpruning" in executed(sliced)
    days = M.measure(golden.mart, M.TRANSACTIONS, ["nb_transactions"], ["date_complete"])
    want = days.where("date_complete = '2023-05-04'").agg(F.sum("nb_transactions")).first()[0]
    assert sliced.agg(F.sum("nb_transactions")).first()[0] == want


def test_other_date_roles_are_not_pruned_by_the_main_month(golden):
    by_end = M.measure(golden.mart, M.CREDITS, ["nb_credits"], [], {"annee": 2025}, date_role="fin_prevue")
    per_year = M.measure(golden.mart, M.CREDITS, ["nb_credits"], ["annee"], date_role="fin_prevue")
    assert by_end.first().nb_credits == per_year.where("annee = 2025").first().nb_credits > 0


def test_facts_are_laid_out_by_month(golden):
    for name, column in facts.MAIN_DATES.items():
        fact = golden.mart[name]
        assert fact.where(F.col(facts.MONTH) != facts.month_key(column)).isEmpty()
        assert all(f"/{facts.MONTH}=" in path for path in fact.inputFiles())


def test_relationships_scan_each_fact_once_and_move_no_row(golden, spark):
    """Even when nothing may be broadcast by size: the key sets are bounded and say so themselves."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = executed(controls.integrity_figures(golden.dims, golden.facts)[0])
        report = executed(controls.relationship_report(golden.dims, golden.facts))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for fact in controls.FACTS:
        assert plan.count(f"/{fact}]") == 1 and report.count(f"/{fact}]") == 1
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan and "NestedLoop" not in plan


def test_distinct_counts_copy_no_fact_row(golden):
    for frame in (
        summaries.targets(golden.mart), summaries.client_entries(golden.mart),
        quality.grid(golden.staging), quality.final_summaries(golden.staging),
    ):
        assert "Expand" not in executed(frame)
    plan = executed(summaries.client_entries(golden.mart))
    assert plan.count("FileScan") == 1 and plan.count("HashAggregate") >= 2 and "SortAggregate" not in plan


def test_unknown_keys_are_compared_in_their_own_type(golden):
    """Days stay days and each table is read once for all of its keys."""
    plan = executed(controls.unknown_key_figures(golden.staging, golden.dims))
    days = re.findall(r"cast\((?:date_transaction|date_octroi|date_fin_prevue|date_echeance|date_paiement|mois|date_entree)#\d+ as string\)", plan)
    assert not days and "date_complete" in plan and "as string) AS _fk" not in plan
    assert plan.count("/transactions]") == 1
