"""Calendar dimension covering every date of the warehouse."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions import dates

# Bounds when no source holds any date.
DEFAULT_FIRST = "2021-01-01"
DEFAULT_LAST = "2026-12-31"

# Every date that must find its day in the calendar.
SOURCES = (
    ("clients", ("date_entree",)),
    ("transactions", ("date_transaction",)),
    ("credits", ("date_octroi", "date_fin_prevue")),
    ("remboursements", ("date_echeance", "date_paiement")),
    ("objectifs_agences", ("mois",)),
)

COLUMNS = {
    "date_key": "int",
    "date_complete": "date",
    "jour_numero": "smallint",
    "jour_semaine_numero": "smallint",
    "nom_jour": "string",
    "semaine_iso": "smallint",
    "mois_numero": "smallint",
    "nom_mois": "string",
    "trimestre_numero": "smallint",
    "trimestre_libelle": "string",
    "semestre_numero": "smallint",
    "annee": "smallint",
    "annee_mois": "int",
    "annee_mois_libelle": "string",
    "mois_debut": "date",
    "est_weekend": "boolean",
    "libelle_date": "string",
}


def date_bounds(staging: dict[str, DataFrame]) -> DataFrame:
    """One row with the first and last date; each table is reduced before the union."""
    per_table = []
    for table, columns in SOURCES:
        days = [F.col(c).cast("date") for c in columns]
        low = [F.min(d) for d in days]
        high = [F.max(d) for d in days]
        per_table.append(
            staging[table].agg(
                (F.least(*low) if len(low) > 1 else low[0]).alias("premiere"),
                (F.greatest(*high) if len(high) > 1 else high[0]).alias("derniere"),
            )
        )
    merged = reduce(DataFrame.unionByName, per_table)
    return merged.agg(F.min("premiere").alias("date_min"), F.max("derniere").alias("date_max"))


def days(bounds: DataFrame) -> DataFrame:
    """One row per day between the bounds, both included."""
    first = F.coalesce("date_min", F.lit(DEFAULT_FIRST).cast("date"))
    last = F.coalesce("date_max", F.lit(DEFAULT_LAST).cast("date"))
    step = F.expr("interval 1 day")
    return bounds.select(F.explode(F.sequence(first, last, step)).alias("date_complete"))


def dim_date(bounds: DataFrame) -> DataFrame:
    d = F.col("date_complete")
    quarter = F.quarter(d)
    weekday = dates.weekday_number(d)
    attributes = {
        "date_key": dates.date_key(d),
        "date_complete": d,
        "jour_numero": F.dayofmonth(d),
        "jour_semaine_numero": weekday,
        "nom_jour": dates.day_name(d),
        "semaine_iso": F.weekofyear(d),
        "mois_numero": F.month(d),
        "nom_mois": dates.month_name(d),
        "trimestre_numero": quarter,
        "trimestre_libelle": F.concat(F.lit("T"), quarter.cast("string")),
        "semestre_numero": F.when(F.month(d) <= 6, 1).otherwise(2),
        "annee": F.year(d),
        "annee_mois": F.year(d) * 100 + F.month(d),
        "annee_mois_libelle": F.date_format(d, "yyyy-MM"),
        "mois_debut": F.trunc(d, "MM"),
        "est_weekend": weekday >= 6,
        "libelle_date": dates.french_date(d),
    }
    known = days(bounds).select(*[attributes[c].cast(t).alias(c) for c, t in COLUMNS.items()])
    return known.unionByName(unknown_day(bounds))


def unknown_day(bounds: DataFrame) -> DataFrame:
    """Key 0: the day of rows whose date is missing or unreadable."""
    given = {"date_key": 0, "nom_jour": "Inconnu", "nom_mois": "Inconnu", "libelle_date": "Date inconnue"}
    return bounds.sparkSession.range(1).select(
        *[F.lit(given.get(c)).cast(t).alias(c) for c, t in COLUMNS.items()]
    )
