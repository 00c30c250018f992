"""One-row business summaries over the mart, and the cause of unknown branches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.operators.bitmaps import totals_and_distincts
from ledgerflow.plans.controls import instalments_per_credit

Tables = dict[str, DataFrame]


def _amount(column: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0)).cast("decimal(38,2)")


def transactions(mart: Tables) -> DataFrame:
    return mart["fact_transactions"].agg(
        F.sum("nombre_transactions").alias("nombre_transactions"),
        _amount("montant_debit").alias("montant_total_debits"),
        _amount("montant_credit").alias("montant_total_credits"),
        _amount("frais").alias("total_frais"),
    )


def credits(mart: Tables) -> DataFrame:
    return mart["fact_credits"].agg(
        F.sum("nombre_credits").alias("nombre_credits"),
        _amount("montant_initial").alias("production_totale_credit"),
        F.avg("taux_annuel").cast("decimal(10,3)").alias("taux_annuel_moyen"),
        F.count_if(F.col("taux_annuel").isNull()).alias("taux_annuels_invalides"),
    )


def repayments(mart: Tables) -> DataFrame:
    return mart["fact_remboursements"].agg(
        F.sum("nombre_echeances").alias("nombre_echeances"),
        F.sum(F.col("est_impaye").cast("int")).alias("nombre_impayes"),
        F.sum(F.col("est_en_retard").cast("int")).alias("nombre_paiements_en_retard"),
        _amount("montant_attendu").alias("montant_total_attendu"),
        _amount("montant_paye").alias("montant_total_paye"),
        _amount("montant_non_paye").alias("montant_total_non_paye"),
    )


def targets(mart: Tables) -> DataFrame:
    sums = ("objectif_revenu", "objectif_nouveaux_clients", "objectif_production_credit", "nombre_lignes_objectif")
    row = totals_and_distincts(
        mart["fact_objectifs_agences"],
        {c: F.col(c) for c in sums},
        {"agences_concernees": "agence_key", "mois_distincts": "date_key"},
    )
    return row.select(
        "nombre_lignes_objectif",
        "agences_concernees",
        "mois_distincts",
        _kept("objectif_revenu", "decimal(38,2)"),
        _kept("objectif_nouveaux_clients", "bigint"),
        _kept("objectif_production_credit", "decimal(38,2)"),
    )


def _kept(figure: str, kind: str) -> Column:
    return F.coalesce(F.col(figure), F.lit(0)).cast(kind).alias(f"{figure}_total")


def client_entries(mart: Tables) -> DataFrame:
    row = totals_and_distincts(
        mart["fact_entrees_clients"],
        {"nombre_total_entrees_clients": F.col("nombre_nouveaux_clients")},
        {"clients_distincts": "client_key", "agences_concernees": "agence_key", "dates_entree_distinctes": "date_key"},
    )
    return row.select("nombre_total_entrees_clients", "clients_distincts", "agences_concernees", "dates_entree_distinctes")


def unknown_branch_causes(staging: Tables, dims: Tables) -> DataFrame:
    """Why instalments have no branch: no credit, or a credit whose branch is unknown."""
    cause = F.when(~F.col("_credit_trouve"), "Crédit introuvable").when(
        ~F.col("_agence_trouvee"), "Agence du crédit inconnue"
    )
    return (
        instalments_per_credit(staging, dims)
        .withColumn("cause_agence_inconnue", cause)
        .where(F.col("cause_agence_inconnue").isNotNull())
        .groupBy("cause_agence_inconnue")
        .agg(F.sum("_rows").alias("nombre_echeances"))
    )
