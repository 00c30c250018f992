"""Fact tables: foreign keys resolved to dimension keys, 0 when unknown.

The calendar holds at most one row per representable day (dates are written
yyyy-MM-dd, so fewer than 3.7 million), which bounds its broadcast. The other
lists go through the engine's own size check; identifiers that many rows share,
in any lookup of a table, are found in one pass and spread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.functions.rules import (
    EN_RETARD,
    IMPAYE,
    counter,
    is_status,
    key_or_unknown,
    side_amount,
    unpaid_amount,
)
from ledgerflow.functions.text import reference_key
from ledgerflow.operators.lookup import resolve_key, split_left_join
from ledgerflow.operators.skew import Skew, find_skew

Tables = dict[str, DataFrame]

# --- fixed values: the main date of each fact, by whose month its files are laid out --
MAIN_DATES = {
    "fact_transactions": "date_key",
    "fact_credits": "date_octroi_key",
    "fact_remboursements": "date_echeance_key",
    "fact_objectifs_agences": "date_key",
    "fact_entrees_clients": "date_key",
}
# Partition column of the published facts: year and month of the main date, 0 when unknown.
MONTH = "mois_key"


def month_key(date_key: str) -> Column:
    """Year and month (yyyyMM) of a day key (yyyyMMdd)."""
    return F.expr(f"cast({date_key} div 100 as int)")


def by_month(fact: DataFrame, main_date: str, derived: dict[str, Column] | None = None) -> DataFrame:
    """The fact with its month, dealt out for files of one month each.

    The rebalance splits a month that holds more than a file should and joins
    nothing across months, so neither a hot month nor many tasks make bad files.
    ``derived`` columns follow from the others and are made after the move.
    """
    moved = fact.drop(*(derived or {})).withColumn(MONTH, month_key(main_date)).hint("rebalance", F.col(MONTH))
    return moved.withColumns(derived).select(*fact.columns, MONTH) if derived else moved


def derived(name: str) -> dict[str, Column]:
    """The columns of a fact that follow from its other columns."""
    sens, signed, status = F.col("sens"), F.col("montant_signe"), F.col("statut_remboursement")
    if name == "fact_transactions":
        return {
            "montant_debit": side_amount(sens, signed, "Débit"),
            "montant_credit": side_amount(sens, signed, "Crédit"),
            "nombre_transactions": counter(),
        }
    if name == "fact_credits":
        return {"nombre_credits": counter()}
    if name == "fact_remboursements":
        return {
            "montant_non_paye": unpaid_amount(F.col("montant_attendu"), F.col("montant_paye")),
            "est_impaye": is_status(status, IMPAYE),
            "est_en_retard": is_status(status, EN_RETARD),
            "nombre_echeances": counter(),
        }
    return {}


def _day(df: DataFrame, dims: Tables, column: str, alias: str) -> DataFrame:
    return resolve_key(
        df, F.col(column).cast("date"), dims["dim_date"], "date_complete", "date_key", alias,
        broadcast=True,
    )


def _found(df: DataFrame, dims: Tables, skew: dict[str, Skew], column: str, dim: str, spread_by: list[str]) -> DataFrame:
    """The key of a branch, client or product, hot identifiers spread."""
    name = dim.removeprefix("dim_")
    return resolve_key(
        df, F.col(column), dims[dim], f"{name}_id", f"{name}_key", f"{name}_key", spread_by=spread_by, hot=skew[column]
    )


def _skew(df: DataFrame, *columns: str) -> dict[str, Skew]:
    return find_skew(df, {c: F.col(c) for c in columns})


def fact_transactions(staging: Tables, dims: Tables) -> DataFrame:
    t = staging["transactions"]
    skew = _skew(t, "client_id", "produit_id", "agence_id")
    keyed = _day(t, dims, "date_transaction", "date_key")
    for column, dim in (("client_id", "dim_client"), ("produit_id", "dim_produit"), ("agence_id", "dim_agence")):
        keyed = _found(keyed, dims, skew, column, dim, ["transaction_id"])
    return keyed.withColumnRenamed("montant", "montant_signe").withColumns(derived("fact_transactions")).select(
        "transaction_id",
        "date_key",
        "client_key",
        "produit_key",
        "agence_key",
        "type_transaction",
        "montant_signe",
        "montant_debit",
        "montant_credit",
        "sens",
        "canal",
        "statut",
        "frais",
        "devise",
        "nombre_transactions",
    )


def fact_credits(staging: Tables, dims: Tables) -> DataFrame:
    cr = staging["credits"]
    keyed = _day(_holders(cr, dims), dims, "date_octroi", "date_octroi_key")
    keyed = _day(keyed, dims, "date_fin_prevue", "date_fin_prevue_key")
    return keyed.withColumns(derived("fact_credits")).select(
        "credit_id",
        "date_octroi_key",
        "date_fin_prevue_key",
        "client_key",
        "agence_key",
        "type_credit",
        "montant_initial",
        "taux_annuel",
        "duree_mois",
        "mensualite_theorique",
        "score_risque_octroi",
        "statut_credit",
        "nombre_credits",
    )


def _holders(credits: DataFrame, dims: Tables) -> DataFrame:
    """Credits with the keys of their client and branch."""
    skew = _skew(credits, "client_id", "agence_id")
    for column, dim in (("client_id", "dim_client"), ("agence_id", "dim_agence")):
        credits = _found(credits, dims, skew, column, dim, ["credit_id"])
    return credits


def credit_bridge(staging: Tables, dims: Tables, credits: DataFrame | None = None) -> DataFrame:
    """What an instalment takes over from its credit, resolved once per credit.

    Looking clients and branches up at credit grain leaves the far larger
    instalment table with a single shuffled join. ``credits`` is the credit
    fact, if it is written already: its keys are these.
    """
    cr = staging["credits"].select(
        "credit_id", "client_id", "agence_id", "type_credit", "statut_credit"
    )
    keyed = _holders(cr, dims) if credits is None else credits
    return keyed.where(F.col("credit_id").isNotNull()).select(
        F.col("credit_id").alias("_credit"), "client_key", "agence_key", "type_credit",
        "statut_credit",
    )


def fact_remboursements(staging: Tables, dims: Tables, credits: DataFrame | None = None) -> DataFrame:
    r = staging["remboursements"]
    joined = split_left_join(
        r, credit_bridge(staging, dims, credits), F.col("credit_id"), "_credit", ["remboursement_id"],
        _skew(r, "credit_id")["credit_id"],
    )
    joined = _day(joined, dims, "date_echeance", "date_echeance_key")
    joined = _day(joined, dims, "date_paiement", "date_paiement_key")
    return joined.withColumns(derived("fact_remboursements")).select(
        "remboursement_id",
        "credit_id",
        "date_echeance_key",
        "date_paiement_key",
        key_or_unknown(F.col("client_key")).alias("client_key"),
        key_or_unknown(F.col("agence_key")).alias("agence_key"),
        "type_credit",
        "statut_credit",
        "montant_attendu",
        "montant_paye",
        "montant_non_paye",
        "jours_retard",
        "statut_remboursement",
        "est_impaye",
        "est_en_retard",
        "nombre_echeances",
    )


def fact_objectifs_agences(staging: Tables, dims: Tables) -> DataFrame:
    targets = staging["objectifs_agences"]
    keyed = _day(targets, dims, "mois", "date_key")
    keyed = _found(keyed, dims, _skew(targets, "agence_id"), "agence_id", "dim_agence", ["agence_id", "mois"])
    return keyed.select(
        "date_key",
        "agence_key",
        "objectif_revenu",
        "objectif_nouveaux_clients",
        "objectif_production_credit",
        "seuil_taux_impaye_pct",
        counter().alias("nombre_lignes_objectif"),
    )


def fact_entrees_clients(staging: Tables, dims: Tables) -> DataFrame:
    """One row per client, from the dimension itself: it has a member for each staging row and knows its key.

    Identifiers that only differ in spelling answer with the least key of them,
    as in every lookup; a client without identifier is unknown.
    """
    members = dims["dim_client"].where("client_key <> 0")
    own = reference_key(F.col("client_id"))
    # Members without identifier are groups of their own, so that many of them are no group.
    alike = Window.partitionBy(F.coalesce(own, F.concat(F.lit("\0"), F.col("client_key"))))
    c = members.select(
        "date_entree",
        F.col("agence_rattachement_id").alias("agence_id"),
        "client_key",
        F.when(own.isNotNull(), F.min("client_key").over(alike)).alias("_least"),
    )
    keyed = _day(c, dims, "date_entree", "date_key")
    keyed = _found(keyed, dims, _skew(members.select(F.col("agence_rattachement_id").alias("agence_id")), "agence_id"),
                   "agence_id", "dim_agence", ["client_key"])
    return keyed.select(
        "date_key", key_or_unknown(F.col("_least")).alias("client_key"), "agence_key",
        counter().alias("nombre_nouveaux_clients"),
    )


JOBS = {
    "fact_transactions": fact_transactions,
    "fact_credits": fact_credits,
    "fact_remboursements": fact_remboursements,
    "fact_objectifs_agences": fact_objectifs_agences,
    "fact_entrees_clients": fact_entrees_clients,
}


def build_facts(staging: Tables, dims: Tables) -> Tables:
    return {name: job(staging, dims) for name, job in JOBS.items()}
