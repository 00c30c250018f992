"""Raw text -> typed, cleaned, deduplicated staging tables.

No value is invented: what cannot be read or referenced becomes NULL and the
row stays. Each job is one lazy plan; only deduplication and references that
grow with the data shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions import domains
from ledgerflow.functions.domains import spelling_map
from ledgerflow.functions.parsing import (
    month_start,
    safe_date,
    safe_decimal,
    safe_int,
    safe_timestamp,
)
from ledgerflow.functions.rules import null_if_negative, repayment_status
from ledgerflow.functions.text import blank_to_null, canonical, clean_code, clean_text, repair_accents
from ledgerflow.operators.dedup import first_of_lines, occurrence_key
from ledgerflow.operators.lookup import null_orphans
from ledgerflow.operators.skew import find_skew

Raw = dict[str, DataFrame]


def _trimmed(df: DataFrame) -> DataFrame:
    """All columns without outer spaces, blanks as NULL.

    A projection of its own: the cleaning above it reads every value several
    times and would otherwise trim it as often.
    """
    return df.select(*[blank_to_null(F.col(c)).alias(c) for c in df.columns])


# The helpers below expect trimmed columns.
def _text(*columns: str) -> list[Column]:
    return [repair_accents(F.col(c)).alias(c) for c in columns]


def _code(*columns: str) -> list[Column]:
    return [F.upper(repair_accents(F.col(c))).alias(c) for c in columns]


def _date(*columns: str) -> list[Column]:
    return [safe_date(F.col(c), trimmed=True).alias(c) for c in columns]


def _int(*columns: str) -> list[Column]:
    return [safe_int(F.col(c), trimmed=True).alias(c) for c in columns]


def _decimal(precision: int, scale: int, *columns: str) -> list[Column]:
    return [safe_decimal(F.col(c), precision, scale, trimmed=True).alias(c) for c in columns]


def _relabel(df: DataFrame, spellings: dict[str, dict[str, str]]) -> DataFrame:
    return df.withColumns({c: canonical(F.col(c), m) for c, m in spellings.items()})


def _first_occurrence(
    raw: Raw, table: str, typed: Callable[[Raw], DataFrame], id_col: str, clean: Callable[[Column], Column]
) -> DataFrame:
    """First source line per identifier (made comparable by ``clean``); the other columns only settle ties."""
    line = F.col("ligne_source")
    rest = [F.col(c) for c in typed(raw).columns if c not in (id_col, "ligne_source")]
    return first_of_lines(
        raw[table], occurrence_key(clean(F.col(id_col)), safe_int(line)), lambda lines: typed({table: lines}),
        occurrence_key(F.col(id_col), line), [line, *rest],
    )


def stage_agences(raw: Raw) -> DataFrame:
    typed = _trimmed(raw["agences"]).select(
        *_text("agence_id", "nom_agence", "ville", "code_postal", "departement", "region"),
        *_date("date_ouverture"),
        *_int("effectif"),
        *_text("categorie_agence"),
    )
    return _relabel(typed, {"categorie_agence": spelling_map(domains.CATEGORIE_AGENCE)})


def typed_clients(raw: Raw) -> DataFrame:
    return _trimmed(raw["clients"]).select(
        *_int("ligne_source"),
        *_text("client_id", "prenom", "nom"),
        *_date("date_naissance", "date_entree"),
        *_text("segment", "profession"),
        *_decimal(12, 2, "revenu_mensuel"),
        *_int("score_risque_initial"),
        *_text("agence_id", "ville", "code_postal", "email", "statut_client"),
    )


def stage_clients(raw: Raw) -> DataFrame:
    unique = _first_occurrence(raw, "clients", typed_clients, "client_id", clean_text)
    labelled = _relabel(
        unique,
        {
            "segment": spelling_map(domains.SEGMENT),
            "profession": spelling_map(domains.PROFESSION),
            "statut_client": spelling_map(domains.STATUT_CLIENT),
        },
    )
    return labelled.withColumns(
        {
            "revenu_mensuel": null_if_negative(F.col("revenu_mensuel")),
            "email": F.lower("email"),
        }
    )


def typed_credits(raw: Raw) -> DataFrame:
    return _trimmed(raw["credits"]).select(
        *_int("ligne_source"),
        *_text("credit_id", "client_id", "agence_id", "type_credit"),
        *_date("date_octroi"),
        *_decimal(15, 2, "montant_initial"),
        *_decimal(6, 3, "taux_annuel"),
        *_int("duree_mois"),
        *_decimal(15, 2, "mensualite_theorique"),
        *_int("score_risque_octroi"),
        *_text("statut_credit"),
        *_date("date_fin_prevue"),
    )


def stage_credits(raw: Raw) -> DataFrame:
    typed = typed_credits(raw)
    columns = typed.columns
    known = null_orphans(
        _first_occurrence(raw, "credits", typed_credits, "credit_id", clean_text),
        {
            "client_id": (raw["clients"], "client_id"),
            "agence_id": (raw["agences"], "agence_id"),
        },
        large=find_skew(typed, {c: F.upper(c) for c in ("client_id", "agence_id")}),
        spread_by=["credit_id", "ligne_source"],
        values=typed,
    )
    labelled = _relabel(
        known,
        {
            "type_credit": spelling_map(domains.TYPE_CREDIT),
            "statut_credit": spelling_map(domains.STATUT_CREDIT),
        },
    )
    return labelled.withColumn("taux_annuel", null_if_negative(F.col("taux_annuel"))).select(columns)


def stage_objectifs(raw: Raw) -> DataFrame:
    return _trimmed(raw["objectifs_agences"]).select(
        "agence_id",
        month_start(F.col("mois"), trimmed=True).alias("mois"),
        *_decimal(15, 2, "objectif_revenu"),
        *_int("objectif_nouveaux_clients"),
        *_decimal(15, 2, "objectif_production_credit"),
        *_decimal(5, 2, "seuil_taux_impaye_pct"),
    )


def stage_produits(raw: Raw) -> DataFrame:
    typed = _trimmed(raw["produits"]).select(
        *_code("produit_id"),
        *_text("nom_produit", "famille_produit", "univers"),
        *_int("niveau_complexite"),
    )
    return _relabel(
        typed,
        {
            "famille_produit": spelling_map(domains.FAMILLE_PRODUIT),
            "univers": spelling_map(domains.UNIVERS),
        },
    )


def stage_remboursements(raw: Raw) -> DataFrame:
    """Every instalment line is kept; the status is derived before negative payments are dropped."""
    typed = _trimmed(raw["remboursements"]).select(
        *_code("remboursement_id", "credit_id"),
        *_date("date_echeance", "date_paiement"),
        *_decimal(15, 2, "montant_attendu", "montant_paye"),
        *_int("jours_retard"),
        *_text("statut_remboursement"),
    )
    known = null_orphans(
        typed,
        {"credit_id": (raw["credits"], "credit_id")},
        large=find_skew(typed, {"credit_id": F.col("credit_id")}),
        spread_by=["remboursement_id"],
    )
    status = repayment_status(
        F.col("montant_paye"),
        F.col("date_paiement"),
        F.col("jours_retard"),
        F.col("statut_remboursement"),
    )
    return known.withColumn("statut_remboursement", status).withColumn(
        "montant_paye", null_if_negative(F.col("montant_paye"))
    ).select(typed.columns)


def typed_transactions(raw: Raw) -> DataFrame:
    return _trimmed(raw["transactions"]).select(
        *_int("ligne_source"),
        *_code("transaction_id", "client_id"),
        safe_timestamp(F.col("date_transaction"), trimmed=True).alias("date_transaction"),
        *_text("type_transaction"),
        *_decimal(15, 2, "montant"),
        *_text("sens"),
        *_code("produit_id", "agence_id"),
        *_text("canal", "statut"),
        *_decimal(15, 2, "frais"),
        *_code("devise"),
    )


def stage_transactions(raw: Raw) -> DataFrame:
    typed = typed_transactions(raw)
    columns = typed.columns
    known = null_orphans(
        _first_occurrence(raw, "transactions", typed_transactions, "transaction_id", clean_code),
        {
            "client_id": (raw["clients"], "client_id"),
            "produit_id": (raw["produits"], "produit_id"),
            "agence_id": (raw["agences"], "agence_id"),
        },
        large=find_skew(typed, {c: F.col(c) for c in ("client_id", "produit_id", "agence_id")}),
        spread_by=["transaction_id", "ligne_source"],
        values=typed,
    )
    return _relabel(
        known,
        {
            "type_transaction": spelling_map(domains.TYPE_TRANSACTION),
            "sens": spelling_map(domains.SENS, domains.UNACCENTED_SENS),
            "canal": spelling_map(domains.CANAL),
            "statut": spelling_map(
                domains.STATUT_TRANSACTION, domains.UNACCENTED_STATUT_TRANSACTION
            ),
        },
    ).select(columns)


JOBS = {
    "agences": stage_agences,
    "clients": stage_clients,
    "credits": stage_credits,
    "objectifs_agences": stage_objectifs,
    "produits": stage_produits,
    "remboursements": stage_remboursements,
    "transactions": stage_transactions,
}


def stage_all(raw: Raw) -> dict[str, DataFrame]:
    return {table: job(raw) for table, job in JOBS.items()}
