"""Declared schemas: nothing is inferred from files.

Column names, order and types are the data contract of the warehouse.
"""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType

# --- fixed values: raw columns, in file order --------------------------------
RAW_COLUMNS: dict[str, tuple[str, ...]] = {
    "agences": (
        "agence_id", "nom_agence", "ville", "code_postal", "departement", "region",
        "date_ouverture", "effectif", "categorie_agence",
    ),
    "clients": (
        "ligne_source", "client_id", "prenom", "nom", "date_naissance", "date_entree",
        "segment", "profession", "revenu_mensuel", "score_risque_initial", "agence_id",
        "ville", "code_postal", "email", "statut_client",
    ),
    "credits": (
        "ligne_source", "credit_id", "client_id", "agence_id", "type_credit", "date_octroi",
        "montant_initial", "taux_annuel", "duree_mois", "mensualite_theorique",
        "score_risque_octroi", "statut_credit", "date_fin_prevue",
    ),
    "objectifs_agences": (
        "agence_id", "mois", "objectif_revenu", "objectif_nouveaux_clients",
        "objectif_production_credit", "seuil_taux_impaye_pct",
    ),
    "produits": (
        "produit_id", "nom_produit", "famille_produit", "univers", "niveau_complexite",
    ),
    "remboursements": (
        "remboursement_id", "credit_id", "date_echeance", "date_paiement", "montant_attendu",
        "montant_paye", "jours_retard", "statut_remboursement",
    ),
    "transactions": (
        "ligne_source", "transaction_id", "client_id", "date_transaction", "type_transaction",
        "montant", "sens", "produit_id", "agence_id", "canal", "statut", "frais", "devise",
    ),
}

# --- fixed values: staging types that differ from text ------------------------
STAGING_TYPES: dict[str, dict[str, str]] = {
    "agences": {"date_ouverture": "date", "effectif": "int"},
    "clients": {
        "ligne_source": "int", "date_naissance": "date", "date_entree": "date",
        "revenu_mensuel": "decimal(12,2)", "score_risque_initial": "int",
    },
    "credits": {
        "ligne_source": "int", "date_octroi": "date", "montant_initial": "decimal(15,2)",
        "taux_annuel": "decimal(6,3)", "duree_mois": "int",
        "mensualite_theorique": "decimal(15,2)", "score_risque_octroi": "int",
        "date_fin_prevue": "date",
    },
    "objectifs_agences": {
        "mois": "date", "objectif_revenu": "decimal(15,2)", "objectif_nouveaux_clients": "int",
        "objectif_production_credit": "decimal(15,2)", "seuil_taux_impaye_pct": "decimal(5,2)",
    },
    "produits": {"niveau_complexite": "int"},
    "remboursements": {
        "date_echeance": "date", "date_paiement": "date", "montant_attendu": "decimal(15,2)",
        "montant_paye": "decimal(15,2)", "jours_retard": "int",
    },
    "transactions": {
        "ligne_source": "int", "date_transaction": "timestamp_ntz", "montant": "decimal(15,2)",
        "frais": "decimal(15,2)",
    },
}

DIMENSIONS = ("dim_date", "dim_agence", "dim_client", "dim_produit")
FACTS = (
    "fact_transactions",
    "fact_credits",
    "fact_remboursements",
    "fact_objectifs_agences",
    "fact_entrees_clients",
)


def raw_schema(table: str) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in RAW_COLUMNS[table]])


def staging_type(table: str, column: str) -> str:
    return STAGING_TYPES[table].get(column, "string")
