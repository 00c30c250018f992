"""Report queries: one aggregate per visual, every one accepting slicer filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.plans import measures as M

Tables = dict[str, DataFrame]
Filters = dict[str, object] | None

RISK_NAMES = ["nb_echeances", "nb_impayes", "taux_impaye", "montant_non_paye", "taux_recouvrement"]


def _monthly(df: DataFrame) -> DataFrame:
    """Without the unknown day, which belongs to no month."""
    return df.where(F.col("mois_debut").isNotNull())


# ------------------------------------------------------------------- direction
def monthly_revenue(mart: Tables, filters: Filters = None) -> DataFrame:
    return _monthly(M.measure(mart, M.TRANSACTIONS, ["frais_totaux"], ["mois_debut"], filters))


def top_branches(mart: Tables, n: int = 10, filters: Filters = None) -> DataFrame:
    """Branches with the highest revenue; the identifier settles ties."""
    revenue = M.measure(
        mart, M.TRANSACTIONS, ["frais_totaux", "nb_transactions"], ["agence_id", "agence_libelle"], filters
    )
    return revenue.orderBy(F.desc("frais_totaux"), "agence_id").limit(n)


def transactions_by_type(mart: Tables, filters: Filters = None) -> DataFrame:
    return M.measure(
        mart, M.TRANSACTIONS, ["nb_transactions", "flux_net", "frais_totaux"], ["type_transaction"], filters
    )


def attainment(mart: Tables, filters: Filters = None) -> DataFrame:
    """Overall attainment of the three targets."""
    return M.performance(mart, [], filters)


# ------------------------------------------------------------------ commercial
def monthly_transactions(mart: Tables, filters: Filters = None) -> DataFrame:
    names = ["nb_transactions", "montant_moyen", "nb_rejetees", "taux_rejet"]
    return _monthly(M.measure(mart, M.TRANSACTIONS, names, ["mois_debut"], filters))


def debits_and_credits(mart: Tables, filters: Filters = None) -> DataFrame:
    names = ["montant_debits", "montant_credits", "flux_net"]
    return _monthly(M.measure(mart, M.TRANSACTIONS, names, ["mois_debut"], filters))


def production_by_type(mart: Tables, filters: Filters = None) -> DataFrame:
    names = ["nb_credits", "production_credit", "montant_moyen_credit", "taux_annuel_moyen"]
    return M.measure(mart, M.CREDITS, names, ["type_credit"], filters)


def transactions_by_channel(mart: Tables, filters: Filters = None) -> DataFrame:
    return M.measure(mart, M.TRANSACTIONS, ["nb_transactions", "taux_rejet"], ["canal"], filters)


# --------------------------------------------------------------------- clients
def clients_by(mart: Tables, attribute: str, filters: Filters = None) -> DataFrame:
    """By ``segment``, ``tranche_revenu`` or ``niveau_risque``."""
    return M.client_profile(mart, [attribute], filters)


def most_used_products(mart: Tables, n: int = 10, filters: Filters = None) -> DataFrame:
    used = M.measure(
        mart, M.TRANSACTIONS, ["nb_transactions"], ["produit_id", "produit_libelle"], filters
    )
    return (
        used.where(F.col("produit_id") != "INCONNU")
        .orderBy(F.desc("nb_transactions"), "produit_id")
        .limit(n)
    )


# ------------------------------------------------------------------------ risk
def monthly_unpaid(mart: Tables, filters: Filters = None) -> DataFrame:
    names = ["nb_echeances", "nb_impayes", "taux_impaye"]
    return _monthly(M.measure(mart, M.REPAYMENTS, names, ["mois_debut"], filters))


def expected_and_paid(mart: Tables, filters: Filters = None) -> DataFrame:
    names = ["montant_attendu", "montant_paye", "montant_non_paye", "taux_recouvrement"]
    return _monthly(M.measure(mart, M.REPAYMENTS, names, ["mois_debut"], filters))


def latest_branches(mart: Tables, n: int = 10, filters: Filters = None) -> DataFrame:
    """Branches with the most late payments."""
    names = ["nb_retards", "taux_retard", "jours_retard_moyens"]
    late = M.measure(mart, M.REPAYMENTS, names, ["agence_id"], filters)
    return late.orderBy(F.desc("nb_retards"), "agence_id").limit(n)


def branches_to_watch(mart: Tables, filters: Filters = None) -> DataFrame:
    """Branches whose unpaid rate exceeds their mean alert threshold (in percent)."""
    risk = M.measure(mart, M.REPAYMENTS, RISK_NAMES, ["agence_id"], filters)
    limits = M.measure(mart, M.TARGETS, ["seuil_impaye_pct_moyen"], ["agence_id"], filters)
    rate = F.col("taux_impaye") * 100
    return (
        risk.join(limits, "agence_id", "left")
        .withColumn("taux_impaye_pct", rate)
        .withColumn(
            "a_surveiller", F.coalesce(rate > F.col("seuil_impaye_pct_moyen"), F.lit(False))
        )
        .drop("taux_impaye")
    )


# -------------------------------------------------------------------- branches
def branch_matrix(mart: Tables, filters: Filters = None) -> DataFrame:
    """All targets, gaps and attainments per branch."""
    return M.performance(mart, ["agence_id", "agence_libelle"], filters)


def branch_production(mart: Tables, filters: Filters = None) -> DataFrame:
    return branch_matrix(mart, filters).select(
        "agence_id", "production_credit", "objectif_production_credit", "ecart_production_credit",
        "taux_realisation_production_credit",
    )


def branch_new_clients(mart: Tables, filters: Filters = None) -> DataFrame:
    return branch_matrix(mart, filters).select(
        "agence_id", "nouveaux_clients", "objectif_nouveaux_clients", "ecart_nouveaux_clients",
        "taux_realisation_nouveaux_clients",
    )


def branch_revenue_gap(mart: Tables, filters: Filters = None) -> DataFrame:
    return branch_matrix(mart, filters).select(
        "agence_id", "revenu_realise", "objectif_revenu", "ecart_revenu", "taux_realisation_revenu"
    )


# --------------------------------------------------------------- branch detail
def branch_detail(mart: Tables, agence_id: str, filters: Filters = None) -> DataFrame:
    """Drill-through: one branch, month by month, targets and risk side by side."""
    chosen = {**(filters or {}), "agence_id": agence_id}
    names = ["nb_echeances", "nb_impayes", "taux_impaye"]
    results = M.performance(mart, ["mois_debut"], chosen)
    risk = M.measure(mart, M.REPAYMENTS, names, ["mois_debut"], chosen)
    stacked = _monthly(results.unionByName(risk, allowMissingColumns=True))
    # At most one row per side and month: max only picks the side that has the value.
    return stacked.groupBy("mois_debut").agg(
        *[F.max(c).alias(c) for c in stacked.columns if c != "mois_debut"]
    )
