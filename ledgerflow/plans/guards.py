"""Abort conditions around the dimension and fact builds.

Each guard is a DataFrame with one row per condition (``garde``,
``anomalies``), so it can be inspected as data; ``enforce`` turns a non-zero
count into an error.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.operators.grouping import broken_keys
from ledgerflow.plans.calendar import DEFAULT_FIRST, DEFAULT_LAST, date_bounds
from ledgerflow.sources.layers import counted

Tables = dict[str, DataFrame]

# Business key of every staging table that feeds a fact.
FACT_KEYS = {
    "transactions": ["transaction_id"],
    "credits": ["credit_id"],
    "remboursements": ["remboursement_id"],
    "objectifs_agences": ["mois", "agence_id"],
    "clients": ["client_id"],
}
DIMENSION_KEYS = {
    "dim_date": "date_key",
    "dim_agence": "agence_key",
    "dim_client": "client_key",
    "dim_produit": "produit_key",
}
DIMENSION_SOURCES = {
    "dim_agence": "agences",
    "dim_client": "clients",
    "dim_produit": "produits",
}
FACT_SOURCES = {
    "fact_transactions": "transactions",
    "fact_credits": "credits",
    "fact_remboursements": "remboursements",
    "fact_objectifs_agences": "objectifs_agences",
    "fact_entrees_clients": "clients",
}


class GuardFailed(RuntimeError):
    """A build precondition or postcondition does not hold."""


def _named(df: DataFrame, name: str) -> DataFrame:
    return df.select(F.lit(name).alias("garde"), F.col("anomalies").cast("bigint").alias("anomalies"))


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _row_gap(left: DataFrame, right: DataFrame, surplus: int = 0) -> DataFrame:
    """One row: absolute difference of two row counts (``n``), ``right`` allowed ``surplus`` more."""
    return left.select(F.abs(right.scalar() - F.col("n") - surplus).alias("anomalies"))


# Figure of a published dimension: how many rows hold key 0.
UNKNOWN_ROWS = "inconnus"


def dimension_figures() -> dict[str, dict[str, Column]]:
    """What is observed while the dimensions are written, for the guards and the verdict."""
    return {d: {UNKNOWN_ROWS: _unknown_rows(k)} for d, k in DIMENSION_KEYS.items()}


def _unknown_rows(key: str) -> Column:
    return F.count_if(F.col(key) == 0)


def known_members(dims: Tables, dim: str) -> DataFrame:
    """One row (``n``): members of a dimension besides the unknown one."""
    unknown = counted(dims, dim, UNKNOWN_ROWS, _unknown_rows(DIMENSION_KEYS[dim]))
    return counted(dims, dim).select((F.col("n") - unknown.scalar()).alias("n"))


def unknown_members(dims: Tables) -> DataFrame:
    """Every dimension holds its key 0."""
    return _union(
        [
            _named(
                counted(dims, d, UNKNOWN_ROWS, _unknown_rows(k)).select(
                    F.when(F.col("n") > 0, 0).otherwise(1).alias("anomalies")
                ),
                f"{d}: membre inconnu présent",
            )
            for d, k in DIMENSION_KEYS.items()
        ]
    )


def dimension_guards(staging: Tables, dims: Tables) -> DataFrame:
    """Members = staging rows + 1, calendar days = span of the sources, key 0 present."""
    volumes = [
        _named(_row_gap(counted(staging, s), counted(dims, d), 1), f"{d}: lignes = staging + 1")
        for d, s in DIMENSION_SOURCES.items()
    ]
    first = F.coalesce("date_min", F.lit(DEFAULT_FIRST).cast("date"))
    last = F.coalesce("date_max", F.lit(DEFAULT_LAST).cast("date"))
    calendar = date_bounds(staging).select(
        F.abs(F.datediff(last, first) + 1 - known_members(dims, "dim_date").scalar()).alias("anomalies")
    )
    return _union(
        [*volumes, _named(calendar, "dim_date: jours = étendue"), unknown_members(dims)]
    )


def key_preconditions(staging: Tables) -> DataFrame:
    """Business keys are neither NULL nor repeated."""
    return _union(
        [
            _named(
                broken_keys(staging[t], keys).agg(F.count(F.lit(1)).alias("anomalies")),
                f"{t}: clé métier unique",
            )
            for t, keys in FACT_KEYS.items()
        ]
    )


def fact_preconditions(staging: Tables, dims: Tables) -> DataFrame:
    return key_preconditions(staging).unionByName(unknown_members(dims))


def fact_guards(staging: Tables, facts: Tables) -> DataFrame:
    """Each staging row gives exactly one fact row."""
    return _union(
        [
            _named(_row_gap(counted(staging, s), counted(facts, f)), f"{f}: lignes = staging")
            for f, s in FACT_SOURCES.items()
        ]
    )


def enforce(guards: DataFrame) -> None:
    """Raise when a guard counts an anomaly; the list of guards is short by construction."""
    failed = guards.where("anomalies <> 0").orderBy("garde").collect()
    if failed:
        raise GuardFailed("; ".join(f"{r['garde']} ({r['anomalies']})" for r in failed))
