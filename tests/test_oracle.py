"""Registered queries against DuckDB on the driver tables.

A selection runs by default; LEDGERFLOW_ALL=1 runs every registered query.
"""

import os

import pytest

import __spark_entry__ as entry
from verification import catalog
from verification.compare import compare, duck_connection

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()
SELECTED = (
    "b8_canonical_labels", "b12_repayment_status", "j8_null_orphans", "j10_any_orphan", "w2_first_raw_line",
    "w3_prior_year", "p3_stage_credits", "p6_stage_remboursements", "p7_stage_transactions", "d1_dim_date",
    "d3_dim_client", "k1_fact_transactions", "k3_fact_remboursements", "q10_orphan_references",
    "q12_texts_changed", "m00_all_controls", "x1_by_region_and_segment", "v6_branch_detail", "v7_slicers_risk",
)

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF)


@pytest.mark.parametrize("name", list(ORACLE) if os.environ.get("LEDGERFLOW_ALL") else SELECTED)
def test_query_matches_oracle(spark, con, name):
    problems = compare(QUERIES[name](spark, SF), con, ORACLE[name])
    # An empty list agrees with anything, hence counts as a failure.
    assert problems == ""


def test_every_query_has_an_oracle():
    assert set(catalog.ORACLE) == set(catalog.QUERIES)
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
