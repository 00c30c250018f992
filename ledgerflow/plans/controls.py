"""Controls of the star model: 61 typed rows (expected, observed, gap, status).

Figures are gathered first, one aggregate per table plus one per foreign key
(counted per key value before any join). They meet in a single row holding a
short map, from which every control picks its two sides, so no fact is read
once per control.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.functions.dates import french_date
from ledgerflow.functions.predicates import any_of
from ledgerflow.functions.rules import EN_RETARD, IMPAYE, is_status, unpaid_amount
from ledgerflow.functions.text import message, reference_key
from ledgerflow.operators.bitmaps import key_set
from ledgerflow.operators.checks import ATTENTION, OK, unpivot
from ledgerflow.operators.lookup import Lookup, broken_keys, unmatched_counts
from ledgerflow.plans.calendar import date_bounds
from ledgerflow.plans.guards import DIMENSION_KEYS, known_members
from ledgerflow.sources.layers import counted, present_tables, require_published

Tables = dict[str, DataFrame]
VALUE = "decimal(38,4)"

# --- fixed values: tables that must exist, and the job that creates them --------
REQUIRED = (
    ("staging.agences", "staging"),
    ("staging.clients", "staging"),
    ("staging.credits", "staging"),
    ("staging.objectifs_agences", "staging"),
    ("staging.produits", "staging"),
    ("staging.remboursements", "staging"),
    ("staging.transactions", "staging"),
    ("mart.dim_date", "dimensions"),
    ("mart.dim_agence", "dimensions"),
    ("mart.dim_client", "dimensions"),
    ("mart.dim_produit", "dimensions"),
    ("mart.fact_transactions", "facts"),
    ("mart.fact_credits", "facts"),
    ("mart.fact_remboursements", "facts"),
    ("mart.fact_objectifs_agences", "facts"),
    ("mart.fact_entrees_clients", "facts"),
)

# --- fixed values: the 17 relationships (fact, foreign key, dimension) ----------
RELATIONSHIPS = (
    ("fact_transactions", "date_key", "dim_date"),
    ("fact_transactions", "client_key", "dim_client"),
    ("fact_transactions", "produit_key", "dim_produit"),
    ("fact_transactions", "agence_key", "dim_agence"),
    ("fact_credits", "date_octroi_key", "dim_date"),
    ("fact_credits", "date_fin_prevue_key", "dim_date"),
    ("fact_credits", "client_key", "dim_client"),
    ("fact_credits", "agence_key", "dim_agence"),
    ("fact_remboursements", "date_echeance_key", "dim_date"),
    ("fact_remboursements", "date_paiement_key", "dim_date"),
    ("fact_remboursements", "client_key", "dim_client"),
    ("fact_remboursements", "agence_key", "dim_agence"),
    ("fact_objectifs_agences", "date_key", "dim_date"),
    ("fact_objectifs_agences", "agence_key", "dim_agence"),
    ("fact_entrees_clients", "date_key", "dim_date"),
    ("fact_entrees_clients", "client_key", "dim_client"),
    ("fact_entrees_clients", "agence_key", "dim_agence"),
)
FACTS = tuple(dict.fromkeys(fact for fact, _, _ in RELATIONSHIPS))


@dataclass(frozen=True)
class Control:
    """A figure and what it should be: another figure (by name) or a fixed number."""

    category: str
    name: str
    expected: str | int
    observed: str
    detail: str = ""

    @property
    def comment(self) -> str:
        if isinstance(self.expected, str):
            return f"{self.observed} comparé à {self.expected}{self.detail}"
        return f"{self.observed} doit valoir {self.expected}{self.detail}"


# --- fixed values: names of the controls, in report order --------------------------
DIMENSION_VOLUMES = {
    "agence": "Nombre d’agences réelles",
    "client": "Nombre de clients réels",
    "produit": "Nombre de produits réels",
}
FACT_VOLUMES = {
    "fact_transactions": ("transactions", "Nombre de transactions"),
    "fact_credits": ("credits", "Nombre de crédits"),
    "fact_remboursements": ("remboursements", "Nombre d’échéances"),
    "fact_objectifs_agences": ("objectifs_agences", "Nombre d’objectifs agence-mois"),
    "fact_entrees_clients": ("clients", "Nombre d’entrées clients"),
}
UNIQUE_IDS = {
    "Une ligne par transaction": ("fact_transactions", "transaction_id"),
    "Une ligne par crédit": ("fact_credits", "credit_id"),
    "Une ligne par échéance": ("fact_remboursements", "remboursement_id"),
}
UNIQUE_KEYS = {
    "Un objectif par agence et par mois": "objectifs_doublons",
    "Une entrée par client": "entrees_doublons",
}
UNKNOWN_KEYS = (
    ("Dates inconnues", "fact_transactions", "date_key"),
    ("Clients inconnus", "fact_transactions", "client_key"),
    ("Agences inconnues", "fact_transactions", "agence_key"),
    ("Produits inconnus", "fact_transactions", "produit_key"),
    ("Dates d’octroi inconnues", "fact_credits", "date_octroi_key"),
    ("Dates de fin prévues inconnues", "fact_credits", "date_fin_prevue_key"),
    ("Clients inconnus", "fact_credits", "client_key"),
    ("Agences inconnues", "fact_credits", "agence_key"),
    ("Dates d’échéance inconnues", "fact_remboursements", "date_echeance_key"),
    ("Dates de paiement inconnues", "fact_remboursements", "date_paiement_key"),
    ("Clients inconnus", "fact_remboursements", "client_key"),
    ("Agences inconnues", "fact_remboursements", "agence_key"),
    ("Dates inconnues", "fact_objectifs_agences", "date_key"),
    ("Agences inconnues", "fact_objectifs_agences", "agence_key"),
    ("Dates inconnues", "fact_entrees_clients", "date_key"),
    ("Clients inconnus", "fact_entrees_clients", "client_key"),
    ("Agences inconnues", "fact_entrees_clients", "agence_key"),
)
AMOUNTS = {
    "Montant signé total des transactions": ("stg_montant", "fact_montant_signe"),
    "Production totale de crédit": ("stg_montant_initial", "fact_montant_initial"),
    "Montant total attendu des remboursements": ("stg_montant_attendu", "fact_montant_attendu"),
    "Montant total payé des remboursements": ("stg_montant_paye", "fact_montant_paye"),
    "Objectif total de revenu": ("stg_objectif_revenu", "fact_objectif_revenu"),
    "Objectif total de production de crédit": (
        "stg_objectif_production_credit", "fact_objectif_production_credit",
    ),
}
INDICATORS = {
    "Compteur nombre_transactions": "nombre_transactions_invalides",
    "Cohérence de montant_debit": "montant_debit_invalides",
    "Cohérence de montant_credit": "montant_credit_invalides",
    "Compteur nombre_credits": "nombre_credits_invalides",
    "Compteur nombre_echeances": "nombre_echeances_invalides",
    "Cohérence de est_impaye": "est_impaye_incoherents",
    "Cohérence de est_en_retard": "est_en_retard_incoherents",
    "Cohérence de montant_non_paye": "montant_non_paye_incoherents",
    "Compteur nombre_lignes_objectif": "nombre_lignes_objectif_invalides",
    "Compteur nombre_nouveaux_clients": "nombre_nouveaux_clients_invalides",
}
# Repayments reach their branch through the credit: the comment splits the two causes.
_BRANCH_CAUSES = (
    " : {credits_introuvables} sans crédit, {agences_credit_inconnues} dont le crédit n’a pas d’agence connue"
)


def _unknown_key_control(label: str, fact: str, fk: str) -> Control:
    detail = _BRANCH_CAUSES if (fact, fk) == ("fact_remboursements", "agence_key") else ""
    sides = f"attendu:{fact}.{fk}", f"observe:{fact}.{fk}"
    return Control("Clés inconnues", f"{label} dans {fact}", *sides, detail)


CONTROLS = (
    Control("Préparation", "Présence des tables nécessaires", len(REQUIRED), "tables_presentes"),
    Control("Dimensions", "Couverture de mart.dim_date", "jours_attendus", "jours_observes",
            " du {premiere_date} au {derniere_date}"),
    *[Control("Dimensions", name, f"stg_{d}s", f"dim_{d}_reels") for d, name in DIMENSION_VOLUMES.items()],
    *[Control("Dimensions", f"Membre inconnu de {d}", 1, f"{d}_inconnus") for d in DIMENSION_KEYS],
    *[Control("Dimensions", f"Unicité de {d}_id", f"dim_{d}_reels", f"dim_{d}_distincts")
      for d in DIMENSION_VOLUMES],
    *[Control("Tables de faits", name, f"stg_{t}", f"{fact}_lignes") for fact, (t, name) in FACT_VOLUMES.items()],
    *[Control("Grains", name, f"{fact}_lignes", f"{c}_distincts") for name, (fact, c) in UNIQUE_IDS.items()],
    *[Control("Grains", name, 0, figure) for name, figure in UNIQUE_KEYS.items()],
    *[_unknown_key_control(*entry) for entry in UNKNOWN_KEYS],
    *[Control("Montants", name, *sides) for name, sides in AMOUNTS.items()],
    *[Control("Indicateurs", name, 0, figure) for name, figure in INDICATORS.items()],
    *[Control("Relations", f"Clés orphelines dans {fact}", 0, f"orphelins:{fact}") for fact in FACTS],
    Control("Relations", "Relations vérifiées", len(RELATIONSHIPS), "relations_verifiees"),
)


# ------------------------------------------------------------------- figures
def _total(column: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0)).cast("decimal(38,2)")


def _rows() -> Column:
    return F.count(F.lit(1))


def staging_totals(staging: Tables) -> list[DataFrame]:
    """Row counts and conserved amounts: one aggregate per staging table."""
    sums = {
        "transactions": ("montant",),
        "credits": ("montant_initial",),
        "remboursements": ("montant_attendu", "montant_paye"),
        "objectifs_agences": ("objectif_revenu", "objectif_production_credit"),
    }
    return [
        df.agg(
            _rows().alias(f"stg_{t}"),
            *[_total(c).alias(f"stg_{c}") for c in sums.get(t, ())],
        )
        for t, df in staging.items()
    ]


def dimension_figures(staging: Tables, dims: Tables) -> list[DataFrame]:
    """Volumes, unknown members and business-key uniqueness: one aggregate per dimension."""
    frames = []
    for dim, key in DIMENSION_KEYS.items():
        real = F.col(key) != 0
        figures = [
            F.count_if(real).alias(f"{dim}_reels"),
            F.count_if(~real).alias(f"{dim}_inconnus"),
        ]
        if dim != "dim_date":
            identifier = F.when(real, F.col(f"{dim[4:]}_id"))
            figures.append(F.countDistinct(identifier).alias(f"{dim}_distincts"))
        frames.append(dims[dim].agg(*figures))
    bounds = date_bounds(staging)
    span = (F.datediff("date_max", "date_min") + 1).alias("jours_attendus")
    days = dims["dim_date"].where(F.col("date_key") != 0).agg(_rows().alias("jours_observes"))
    return [*frames, bounds.select(span), days]


def fact_figures(facts: Tables) -> list[DataFrame]:
    """Volumes, amounts, unknown keys and indicator checks: one aggregate per fact."""
    c = F.col
    debit = c("sens") == "Débit"
    credit = c("sens") == "Crédit"
    signed = F.coalesce(c("montant_signe"), F.lit(0))
    rest = unpaid_amount(c("montant_attendu"), c("montant_paye"))
    specific = {
        "fact_transactions": [
            _total("montant_signe").alias("fact_montant_signe"),
            _not_one("nombre_transactions"),
            F.count_if(
                any_of(
                    debit & (c("montant_debit") != F.abs(signed)),
                    ~F.coalesce(debit, F.lit(False)) & (c("montant_debit") != 0),
                )
            ).alias("montant_debit_invalides"),
            # Against the signed amount: a negative amount labelled as credit must show up.
            F.count_if(
                any_of(
                    credit & (c("montant_credit") != signed),
                    ~F.coalesce(credit, F.lit(False)) & (c("montant_credit") != 0),
                )
            ).alias("montant_credit_invalides"),
        ],
        "fact_credits": [
            _total("montant_initial").alias("fact_montant_initial"),
            _not_one("nombre_credits"),
        ],
        "fact_remboursements": [
            _total("montant_attendu").alias("fact_montant_attendu"),
            _total("montant_paye").alias("fact_montant_paye"),
            _not_one("nombre_echeances"),
            F.count_if(c("est_impaye") != is_status(c("statut_remboursement"), IMPAYE)).alias(
                "est_impaye_incoherents"
            ),
            F.count_if(c("est_en_retard") != is_status(c("statut_remboursement"), EN_RETARD)).alias(
                "est_en_retard_incoherents"
            ),
            F.count_if(
                any_of(
                    c("montant_paye").isNull() & c("montant_non_paye").isNotNull(),
                    c("montant_paye").isNotNull() & (c("montant_non_paye") != rest),
                )
            ).alias("montant_non_paye_incoherents"),
        ],
        "fact_objectifs_agences": [
            _total("objectif_revenu").alias("fact_objectif_revenu"),
            _total("objectif_production_credit").alias("fact_objectif_production_credit"),
            _not_one("nombre_lignes_objectif"),
        ],
        "fact_entrees_clients": [_not_one("nombre_nouveaux_clients")],
    }
    return [
        facts[fact].agg(
            _rows().alias(f"{fact}_lignes"),
            *[
                F.count_if(F.col(fk) == 0).alias(f"observe:{fact}.{fk}")
                for f, fk, _ in RELATIONSHIPS
                if f == fact
            ],
            *specific[fact],
        )
        for fact in FACTS
    ]


def _not_one(counter: str) -> Column:
    return F.count_if(F.col(counter) != 1).alias(f"{counter}_invalides")


def grain_figures(facts: Tables) -> list[DataFrame]:
    """Distinct identifiers and repeated pairs."""
    distinct = {
        "fact_transactions": "transaction_id",
        "fact_credits": "credit_id",
        "fact_remboursements": "remboursement_id",
    }
    frames = [
        facts[fact].agg(F.countDistinct(c).alias(f"{c}_distincts")) for fact, c in distinct.items()
    ]
    repeated = {
        "objectifs_doublons": ("fact_objectifs_agences", ["date_key", "agence_key"]),
        "entrees_doublons": ("fact_entrees_clients", ["client_key"]),
    }
    frames += [
        facts[fact]
        .groupBy(*keys)
        .agg(_rows().alias("_rows"))
        .agg(F.count_if(F.col("_rows") > 1).alias(name))
        for name, (fact, keys) in repeated.items()
    ]
    return frames


# --- fixed values: (fact, foreign key, staging identifier) looked up directly -----
LOOKUPS = {
    "transactions": (
        ("fact_transactions", "date_key", "date_transaction"),
        ("fact_transactions", "client_key", "client_id"),
        ("fact_transactions", "agence_key", "agence_id"),
        ("fact_transactions", "produit_key", "produit_id"),
    ),
    "credits": (
        ("fact_credits", "date_octroi_key", "date_octroi"),
        ("fact_credits", "date_fin_prevue_key", "date_fin_prevue"),
        ("fact_credits", "client_key", "client_id"),
        ("fact_credits", "agence_key", "agence_id"),
    ),
    "remboursements": (
        ("fact_remboursements", "date_echeance_key", "date_echeance"),
        ("fact_remboursements", "date_paiement_key", "date_paiement"),
    ),
    "objectifs_agences": (
        ("fact_objectifs_agences", "date_key", "mois"),
        ("fact_objectifs_agences", "agence_key", "agence_id"),
    ),
    "clients": (
        ("fact_entrees_clients", "date_key", "date_entree"),
        ("fact_entrees_clients", "client_key", "client_id"),
        ("fact_entrees_clients", "agence_key", "agence_id"),
    ),
}


def unknown_key_figures(staging: Tables, dims: Tables) -> DataFrame:
    """(mesure, valeur): expected unknown keys, recomputed by looking for missing partners."""
    home = {(fact, fk): dim for fact, fk, dim in RELATIONSHIPS}
    business = {d: "date_complete" if d == "dim_date" else f"{d[4:]}_id" for d in DIMENSION_KEYS}
    sources = []
    for table, looked_up in LOOKUPS.items():
        lookups = []
        for fact, fk, column in looked_up:
            dim = home[fact, fk]
            identifier = f"cast({column} as date)" if dim == "dim_date" else f"upper(nullif(trim({column}), ''))"
            lookups.append(Lookup(f"attendu:{fact}.{fk}", dim, identifier))
        sources.append((staging[table], lookups))
    members = {
        d: dims[d].where(F.col(k) != 0).select(
            F.col(business[d]) if d == "dim_date" else reference_key(F.col(business[d])).alias(business[d])
        ).distinct()
        for d, k in DIMENSION_KEYS.items()
    }
    direct = unmatched_counts(sources, members).selectExpr(
        "cle as mesure", f"cast(lignes as {VALUE}) as valeur"
    )
    return direct.union(unpivot(repayment_unknowns(staging, dims), VALUE))


def repayment_unknowns(staging: Tables, dims: Tables) -> DataFrame:
    """One row: instalments without credit, and instalments whose credit lacks a branch or client.

    Instalments are counted per credit first, so the joins run at credit grain.
    """
    per_credit = instalments_per_credit(staging, dims)
    n = F.col("_rows")
    no_credit = ~F.col("_credit_trouve")

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, n)), F.lit(0)).cast("bigint")

    return per_credit.agg(
        total(no_credit).alias("credits_introuvables"),
        total(~no_credit & ~F.col("_agence_trouvee")).alias("agences_credit_inconnues"),
        total(no_credit | ~F.col("_client_trouve")).alias("attendu:fact_remboursements.client_key"),
        total(no_credit | ~F.col("_agence_trouvee")).alias("attendu:fact_remboursements.agence_key"),
    )


def instalments_per_credit(staging: Tables, dims: Tables) -> DataFrame:
    """Number of instalments per credit with the outcome of the two hops behind it."""
    def found(dim: str, column: str, flag: str) -> DataFrame:
        key = DIMENSION_KEYS[dim]
        return dims[dim].where(F.col(key) != 0).select(
            F.col(f"{dim[4:]}_id").alias(column), F.lit(True).alias(flag)
        )

    counts = staging["remboursements"].groupBy("credit_id").agg(_rows().alias("_rows"))
    credits = staging["credits"].select(
        "credit_id", "client_id", "agence_id", F.lit(True).alias("_credit_trouve")
    )
    joined = (
        counts.join(credits, "credit_id", "left")
        .join(found("dim_client", "client_id", "_client_trouve"), "client_id", "left")
        .join(found("dim_agence", "agence_id", "_agence_trouvee"), "agence_id", "left")
    )
    flags = ("_credit_trouve", "_client_trouve", "_agence_trouvee")
    return joined.select(
        "credit_id", "_rows", *[F.coalesce(F.col(f), F.lit(False)).alias(f) for f in flags]
    )


def broken_relationships(dims: Tables, facts: Tables) -> DataFrame:
    """(mesure, valeur): rows breaking each relationship (``fact.foreign_key``) and any of a fact (``orphelins:fact``).

    One scan of each fact, tested against one bitmap of each dimension's keys.
    """
    spark = next(iter(dims.values())).sparkSession
    with ThreadPoolExecutor(len(DIMENSION_KEYS)) as pool:
        made = pool.map(inheritable_thread_target(spark)(lambda d: key_set(dims[d], DIMENSION_KEYS[d])), DIMENSION_KEYS)
        sets = dict(zip(DIMENSION_KEYS.values(), made, strict=True))
    frames = []
    for fact in FACTS:
        fks = [(fk, dims[d], DIMENSION_KEYS[d]) for f, fk, d in RELATIONSHIPS if f == fact]
        counts = broken_keys(facts[fact], fks, f"orphelins:{fact}", sets)
        frames.append(counts.withColumnsRenamed({fk: f"{fact}.{fk}" for fk, _, _ in fks}))
    return reduce(DataFrame.union, [unpivot(f, "bigint") for f in frames])


def relationship_report(dims: Tables, facts: Tables) -> DataFrame:
    """The 17 relationships with the number of rows breaking each."""
    spark = next(iter(facts.values())).sparkSession
    named = [(f"{fact}.{fk}", fact, fk, dim) for fact, fk, dim in RELATIONSHIPS]
    targets = spark.createDataFrame(
        named, "_id string, table_faits string, cle string, dimension string"
    )
    counts = broken_relationships(dims, facts).selectExpr("mesure as _id", "valeur as orphelins")
    return targets.join(counts, "_id").selectExpr(
        "table_faits",
        "cle",
        "dimension",
        "orphelins",
        f"case when orphelins = 0 then '{OK}' else '{ATTENTION}' end as statut",
    )


def integrity_figures(dims: Tables, facts: Tables) -> list[DataFrame]:
    """Rows with any broken key per fact, and how many relationships hold, from one scan per fact."""
    counts = broken_relationships(dims, facts)
    own = F.col("mesure")
    wide = [F.max(F.when(own == f"orphelins:{f}", F.col("valeur"))).alias(f"orphelins:{f}") for f in FACTS]
    held = F.count_if(~own.startswith("orphelins:") & (F.col("valeur") == 0)).alias("relations_verifiees")
    return [counts.agg(*wide, held)]


def required_present(staging: Tables, mart: Tables) -> DataFrame:
    """One row: how many of the required tables are there; of published ones, the files are looked for."""
    there = {f"staging.{t}" for t in present_tables(staging)} | {f"mart.{t}" for t in present_tables(mart)}
    found = sum(name in there for name, _ in REQUIRED)
    spark = next(iter(staging.values())).sparkSession
    return spark.range(1).select(F.lit(found).alias("tables_presentes"))


# ------------------------------------------------------------------- assembly
def figures(staging: Tables, mart: Tables) -> DataFrame:
    """All figures as (mesure, valeur) rows."""
    dims = {k: v for k, v in mart.items() if k in DIMENSION_KEYS}
    facts = {k: mart[k] for k in FACTS}
    frames = [
        required_present(staging, mart),
        *staging_totals(staging),
        *dimension_figures(staging, dims),
        *fact_figures(facts),
        *grain_figures(facts),
        *integrity_figures(dims, facts),
    ]
    rows = [unpivot(f, VALUE) for f in frames]
    return reduce(DataFrame.union, [*rows, unknown_key_figures(staging, dims)])


_DEFINITION = "controle_id int, categorie string, controle string, _a string, _fixe int, _o string, commentaire string"


def definitions(spark: SparkSession) -> DataFrame:
    """The controls as rows; the expected side names a figure or is a fixed number."""
    rows = []
    for i, c in enumerate(CONTROLS, 1):
        named = isinstance(c.expected, str)
        sides = (c.expected, None) if named else (None, c.expected)
        rows.append((i, c.category, c.name, *sides, c.observed, c.comment))
    return spark.createDataFrame(rows, _DEFINITION)


def controls(staging: Tables, mart: Tables) -> DataFrame:
    """The control rows, numbered in report order; a missing table is named before anything is read."""
    require_published(staging, "staging", REQUIRED)
    require_published(mart, "mart", REQUIRED)
    values = figures(staging, mart).agg(
        F.map_from_entries(F.collect_list(F.struct("mesure", "valeur"))).alias("_m")
    )
    bounds = date_bounds(staging)
    span = bounds.select(F.struct(*[french_date(F.col(c)).alias(c) for c in bounds.columns]))
    rows = definitions(bounds.sparkSession).select(
        "*", values.scalar().alias("_m"), span.scalar().alias("_span")
    )
    compared = rows.selectExpr(
        "*",
        f"coalesce(cast(_fixe as {VALUE}), _m[_a]) as valeur_attendue",
        "_m[_o] as valeur_observee",
    )
    written = {
        "premiere_date": "_span.date_min",
        "derniere_date": "_span.date_max",
        "credits_introuvables": "cast(_m['credits_introuvables'] as bigint)",
        "agences_credit_inconnues": "cast(_m['agences_credit_inconnues'] as bigint)",
    }
    comment = "commentaire"
    for name, value in written.items():
        comment = f"replace({comment}, '{{{name}}}', coalesce(cast({value} as string), ''))"
    return compared.selectExpr(
        "controle_id",
        "categorie",
        "controle",
        "valeur_attendue",
        "valeur_observee",
        f"cast(valeur_observee - valeur_attendue as {VALUE}) as ecart",
        f"case when valeur_observee = valeur_attendue then '{OK}' else '{ATTENTION}' end as statut",
        f"{comment} as commentaire",
    )


def verdict(results: DataFrame, mart: Tables) -> DataFrame:
    """One row: how many controls hold, the volumes, and the closing sentence."""
    members = {
        "dates_reelles": "dim_date", "agences_reelles": "dim_agence", "clients_reels": "dim_client", "produits_reels": "dim_produit",
    }
    volumes = {
        "transactions": "fact_transactions",
        "credits": "fact_credits",
        "remboursements": "fact_remboursements",
        "objectifs_agences": "fact_objectifs_agences",
        "entrees_clients": "fact_entrees_clients",
    }
    # By the manifest of the mart, so that no table is read for its volume again.
    counts = [known_members(mart, t).scalar().alias(name) for name, t in members.items()]
    counts += [counted(mart, t).scalar().alias(name) for name, t in volumes.items()]
    row = results.agg(
        _rows().alias("controles_realises"),
        F.count_if(F.col("statut") == OK).alias("controles_ok"),
        F.count_if(F.col("statut") == ATTENTION).alias("controles_attention"),
    ).select("*", *counts)
    c = F.col
    good = message(
        "Modèle validé : ", c("controles_realises"), " contrôles conformes (",
        c("dates_reelles"), " jours, ", c("agences_reelles"), " agences, ",
        c("clients_reels"), " clients, ", c("produits_reels"), " produits ; ",
        c("transactions"), " transactions, ", c("credits"), " crédits, ",
        c("remboursements"), " échéances, ", c("objectifs_agences"), " objectifs, ",
        c("entrees_clients"), " entrées).",
    )
    bad = message(
        "Modèle à vérifier : ", c("controles_attention"), " contrôle(s) en écart sur ",
        c("controles_realises"), ".",
    )
    return row.withColumn(
        "conclusion_finale", F.when(c("controles_attention") == 0, good).otherwise(bad)
    )
