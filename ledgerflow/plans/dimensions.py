"""Branch, client and product dimensions with dense keys and an unknown member."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.text import full_name
from ledgerflow.operators.keys import dense_key
from ledgerflow.plans.calendar import date_bounds, dim_date

# --- fixed values: the unknown members ----------------------------------------
UNKNOWN_AGENCE = {
    "agence_id": "INCONNUE",
    "nom_agence": "Agence inconnue",
    "ville": "Inconnue",
    "departement": "Inconnu",
    "region": "Inconnue",
    "categorie_agence": "Inconnue",
}
UNKNOWN_CLIENT = {
    "client_id": "INCONNU",
    "prenom": "Client",
    "nom": "Inconnu",
    "nom_complet": "Client inconnu",
    "segment": "Inconnu",
    "profession": "Inconnue",
    "agence_rattachement_id": "INCONNUE",
    "ville": "Inconnue",
    "statut_client": "Inconnu",
}
UNKNOWN_PRODUIT = {
    "produit_id": "INCONNU",
    "nom_produit": "Produit inconnu",
    "famille_produit": "Inconnue",
    "univers": "Inconnu",
}


def with_unknown(df: DataFrame, key: str, member: dict[str, str]) -> DataFrame:
    """Add the key-0 row; attributes the member does not give are NULL."""
    row = {key: 0, **member}
    unknown = df.sparkSession.range(1).select(
        *[F.lit(row.get(f.name)).cast(f.dataType).alias(f.name) for f in df.schema.fields]
    )
    return df.unionByName(unknown)


def dim_agence(staging: dict[str, DataFrame]) -> DataFrame:
    keyed = dense_key(staging["agences"], "agence_id", "agence_key")
    return with_unknown(keyed, "agence_key", UNKNOWN_AGENCE)


def dim_client(staging: dict[str, DataFrame]) -> DataFrame:
    members = staging["clients"].select(
        "client_id",
        "prenom",
        "nom",
        full_name(F.col("prenom"), F.col("nom")).alias("nom_complet"),
        "date_naissance",
        "date_entree",
        "segment",
        "profession",
        "revenu_mensuel",
        "score_risque_initial",
        F.col("agence_id").alias("agence_rattachement_id"),
        "ville",
        "code_postal",
        "email",
        "statut_client",
    )
    keyed = dense_key(members, "client_id", "client_key")
    return with_unknown(keyed, "client_key", UNKNOWN_CLIENT)


def dim_produit(staging: dict[str, DataFrame]) -> DataFrame:
    keyed = dense_key(staging["produits"], "produit_id", "produit_key")
    return with_unknown(keyed, "produit_key", UNKNOWN_PRODUIT)


def calendar_dimension(staging: dict[str, DataFrame]) -> DataFrame:
    return dim_date(date_bounds(staging))


JOBS = {
    "dim_date": calendar_dimension,
    "dim_agence": dim_agence,
    "dim_client": dim_client,
    "dim_produit": dim_produit,
}


def build_dimensions(staging: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: job(staging) for name, job in JOBS.items()}
