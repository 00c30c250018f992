"""Business measures over the star, cut by any dimension attribute.

A measure is a formula over additive parts. A slicer on the calendar first
becomes a condition on the months the fact's files are laid out by, so whole
files are left unread; the days, branches and products that the slicers leave
then meet the fact before anything is summed or shuffled. Cut by one dimension
without slicer, the parts are summed per foreign key inside the fact and only
that small result meets the dimension. The client dimension, which grows with
the data, comes last: per client there is one row by then, however hot the client.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.rules import income_band, risk_level
from ledgerflow.functions.text import display_label
from ledgerflow.plans.facts import MAIN_DATES, MONTH, month_key

Tables = dict[str, DataFrame]

# --- fixed values: attributes a report can group or filter by -------------------
ATTRIBUTES = {
    "dim_date": (
        "date_complete", "annee", "annee_mois", "annee_mois_libelle", "mois_debut", "mois_numero",
        "nom_mois", "trimestre_libelle", "trimestre_numero", "semestre_numero", "nom_jour",
        "est_weekend",
    ),
    "dim_agence": (
        "agence_id", "nom_agence", "agence_libelle", "agence_ville", "departement", "region",
        "categorie_agence",
    ),
    "dim_client": (
        "client_id", "segment", "profession", "statut_client", "tranche_revenu", "niveau_risque",
    ),
    "dim_produit": (
        "produit_id", "nom_produit", "produit_libelle", "famille_produit", "univers",
    ),
}
KEYS = {
    "dim_date": "date_key",
    "dim_agence": "agence_key",
    "dim_client": "client_key",
    "dim_produit": "produit_key",
}


def dimension(mart: Tables, name: str) -> DataFrame:
    """A dimension with its presentation columns."""
    c = F.col
    extra = {
        "dim_agence": lambda: {
            "agence_libelle": display_label(c("agence_id"), c("nom_agence")),
            "agence_ville": c("ville"),
        },
        "dim_produit": lambda: {"produit_libelle": display_label(c("produit_id"), c("nom_produit"))},
        "dim_client": lambda: {
            "tranche_revenu": income_band(c("revenu_mensuel")),
            "niveau_risque": risk_level(c("score_risque_initial")),
        },
    }
    made = extra.get(name)
    return mart[name].withColumns(made()) if made else mart[name]


# ------------------------------------------------------------------ definitions
def ratio(part: str, whole: str) -> Column:
    """Safe division: NULL when the whole is 0 or missing."""
    return F.try_divide(F.col(part).cast("double"), F.col(whole).cast("double"))


def amount(part: str) -> Column:
    return F.coalesce(F.col(part), F.lit(0)).cast("decimal(38,2)")


def number(part: str) -> Column:
    return F.coalesce(F.col(part), F.lit(0)).cast("bigint")


@dataclass(frozen=True)
class Model:
    """A fact, its date roles, its additive parts and the measures built from them."""

    fact: str
    date_roles: dict[str, str]
    dimensions: tuple[str, ...]
    own: tuple[str, ...]
    parts: Callable[[], dict[str, Column]] = field(repr=False)
    measures: Callable[[], dict[str, Column]] = field(repr=False)

    def reachable(self, filters: dict[str, object] | None) -> dict[str, object]:
        """The filters that touch this fact: others leave it as it is, as in any star."""
        columns = {c for d in (*self.dimensions, "dim_date") for c in ATTRIBUTES[d]} | set(self.own)
        return {c: v for c, v in (filters or {}).items() if c in columns}

    def date_fk(self, role: str | None) -> str:
        return self.date_roles[role] if role else next(iter(self.date_roles.values()))


def _present(column: str) -> Column:
    return F.col(column).isNotNull().cast("int")


TRANSACTIONS = Model(
    "fact_transactions",
    {"operation": "date_key"},
    ("dim_agence", "dim_client", "dim_produit"),
    ("type_transaction", "sens", "canal", "statut", "devise"),
    lambda: {
        "n": F.col("nombre_transactions"),
        "debits": F.col("montant_debit"),
        "credits": F.col("montant_credit"),
        "fees": F.col("frais"),
        "volume": F.abs("montant_signe"),
        "n_amounts": _present("montant_signe"),
        "n_rejected": F.when(F.col("statut") == "Rejetée", F.col("nombre_transactions")),
    },
    lambda: {
        "nb_transactions": number("n"),
        "montant_debits": amount("debits"),
        "montant_credits": amount("credits"),
        "flux_net": (amount("credits") - amount("debits")).cast("decimal(38,2)"),
        "frais_totaux": amount("fees"),
        "montant_moyen": ratio("volume", "n_amounts"),
        "nb_rejetees": number("n_rejected"),
        "taux_rejet": F.try_divide(
            number("n_rejected").cast("double"), number("n").cast("double")
        ),
    },
)

CREDITS = Model(
    "fact_credits",
    {"octroi": "date_octroi_key", "fin_prevue": "date_fin_prevue_key"},
    ("dim_agence", "dim_client"),
    ("type_credit", "statut_credit"),
    lambda: {
        "n": F.col("nombre_credits"),
        "granted": F.col("montant_initial"),
        "n_granted": _present("montant_initial"),
        "rates": F.col("taux_annuel"),
        "n_rates": _present("taux_annuel"),
        "instalments": F.col("mensualite_theorique"),
        "n_instalments": _present("mensualite_theorique"),
        "scores": F.col("score_risque_octroi"),
        "n_scores": _present("score_risque_octroi"),
    },
    lambda: {
        "nb_credits": number("n"),
        "production_credit": amount("granted"),
        "montant_moyen_credit": ratio("granted", "n_granted"),
        "taux_annuel_moyen": ratio("rates", "n_rates"),
        "mensualite_moyenne": ratio("instalments", "n_instalments"),
        "score_risque_moyen": ratio("scores", "n_scores"),
    },
)

REPAYMENTS = Model(
    "fact_remboursements",
    {"echeance": "date_echeance_key", "paiement": "date_paiement_key"},
    ("dim_agence", "dim_client"),
    ("type_credit", "statut_credit", "statut_remboursement"),
    lambda: {
        "n": F.col("nombre_echeances"),
        "n_unpaid": F.col("est_impaye").cast("int"),
        "n_late": F.col("est_en_retard").cast("int"),
        "expected": F.col("montant_attendu"),
        "paid": F.col("montant_paye"),
        "unpaid": F.col("montant_non_paye"),
        "delays": F.col("jours_retard"),
        "n_delays": _present("jours_retard"),
    },
    lambda: {
        "nb_echeances": number("n"),
        "nb_impayes": number("n_unpaid"),
        "taux_impaye": ratio("n_unpaid", "n"),
        "nb_retards": number("n_late"),
        "taux_retard": ratio("n_late", "n"),
        "montant_attendu": amount("expected"),
        "montant_paye": amount("paid"),
        "montant_non_paye": amount("unpaid"),
        "taux_recouvrement": ratio("paid", "expected"),
        "jours_retard_moyens": ratio("delays", "n_delays"),
    },
)

ENTRIES = Model(
    "fact_entrees_clients",
    {"entree": "date_key"},
    ("dim_agence", "dim_client"),
    (),
    lambda: {"n": F.col("nombre_nouveaux_clients")},
    lambda: {"nouveaux_clients": number("n")},
)

TARGETS = Model(
    "fact_objectifs_agences",
    {"mois": "date_key"},
    ("dim_agence",),
    (),
    lambda: {
        "revenue": F.col("objectif_revenu"),
        "clients": F.col("objectif_nouveaux_clients"),
        "granted": F.col("objectif_production_credit"),
        "thresholds": F.col("seuil_taux_impaye_pct"),
        "n_thresholds": _present("seuil_taux_impaye_pct"),
    },
    lambda: {
        "objectif_revenu": amount("revenue"),
        "objectif_nouveaux_clients": number("clients"),
        "objectif_production_credit": amount("granted"),
        "seuil_impaye_pct_moyen": ratio("thresholds", "n_thresholds"),
    },
)


# ------------------------------------------------------------------- evaluation
def _chosen(value: object) -> list:
    return list(value) if isinstance(value, list | tuple | set) else [value]


def _conditions(filters: dict[str, object], columns: tuple[str, ...]) -> list[Column]:
    return [F.col(column).isin(*_chosen(value)) for column, value in filters.items() if column in columns]


def month_attributes() -> dict[str, Column]:
    """Calendar attributes that a month alone decides, from the month key."""
    key = F.col(MONTH)
    year, month = F.expr(f"{MONTH} div 100"), key % 100
    return {
        "annee": year,
        "annee_mois": key,
        "mois_numero": month,
        "trimestre_numero": F.expr(f"({MONTH} % 100 + 2) div 3"),
        "semestre_numero": F.when(month <= 6, 1).otherwise(2),
        "annee_mois_libelle": F.concat_ws(
            "-", F.lpad(year.cast("string"), 4, "0"), F.lpad(month.cast("string"), 2, "0")
        ),
    }


def month_conditions(filters: dict[str, object]) -> list[Column]:
    """What the slicers say about the month key: known before the scan, hence partition filters.

    They hold for every row the calendar lets through. Slicers that no month
    decides give none; the join on day and month prunes for those at run time.
    """
    attributes = month_attributes()
    return [attributes[c].isin(*_chosen(v)) for c, v in filters.items() if c in attributes]


def measure(
    mart: Tables,
    model: Model,
    names: list[str],
    by: list[str] = (),
    filters: dict[str, object] | None = None,
    date_role: str | None = None,
) -> DataFrame:
    """Measures ``names`` of a fact per ``by``; ``date_role`` picks the date that counts.

    ``filters`` maps attributes to one value or several (report slicers). A
    filter on an attribute the fact has no key for is an error, not ignored.
    """
    filters = filters or {}
    used = [*by, *[f for f in filters if f not in by]]
    keys = {dim: KEYS[dim] for dim in model.dimensions} | {"dim_date": model.date_fk(date_role)}
    homes = {c: dim for dim in keys for c in ATTRIBUTES[dim]}
    unknown = [c for c in used if c not in homes and c not in model.own]
    if unknown:
        raise ValueError(f"{model.fact} has no attribute {', '.join(unknown)}")

    fact = mart[model.fact]
    for condition in _conditions(filters, model.own):
        fact = fact.where(condition)
    # Laid out by the month of the date that counts: the calendar prunes files.
    by_month = MONTH in fact.columns and keys["dim_date"] == MAIN_DATES[model.fact]
    if by_month:
        for condition in month_conditions(filters):
            fact = fact.where(condition)

    members, sliced = {}, set()
    for dim in keys:
        columns = tuple(c for c in used if c not in model.own and homes[c] == dim)
        if columns:
            chosen = dimension(mart, dim)
            for condition in _conditions(filters, columns):
                chosen = chosen.where(condition)
                sliced.add(dim)
            shown = [c for c in columns if c in by]
            members[dim] = chosen.select(F.col(KEYS[dim]).alias(keys[dim]), *[F.col(c).alias(c) for c in shown]), shown

    parts = model.parts()
    # The dimension the sums wait for: clients, or the only one if no slicer narrows it.
    alone = set(members) - sliced if len(members) == 1 else set()
    last = "dim_client" if "dim_client" in members else next(iter(alone), None)
    seen = [c for c in by if c in model.own]
    for dim, (frame, shown) in members.items():
        if dim == last:
            continue
        on = [keys[dim]]
        if dim == "dim_date":
            # Fewer than 3.7 million days, by the written form of a date.
            if by_month and dim in sliced:
                frame, on = frame.withColumn(MONTH, month_key(keys[dim])), [*on, MONTH]
            frame = F.broadcast(frame)
        fact = fact.join(frame, on, "inner" if shown else "left_semi")
        seen += shown
    sums = {n: F.sum(p) for n, p in parts.items()}
    if last:
        frame, _ = members[last]
        reduced = fact.groupBy(keys[last], *seen).agg(*[s.alias(n) for n, s in sums.items()])
        rolled = reduced.join(frame, keys[last]).groupBy(*by).agg(*[F.sum(n).alias(n) for n in parts])
    else:
        rolled = fact.groupBy(*by).agg(*[s.alias(n) for n, s in sums.items()])
    formulas = model.measures()
    return rolled.select(*by, *[formulas[n].alias(n) for n in names])


def client_profile(
    mart: Tables, by: list[str] = (), filters: dict[str, object] | None = None
) -> DataFrame:
    """Number of clients, mean income and mean risk score of the known members."""
    members = dimension(mart, "dim_client").where(F.col("client_key") != 0)
    for condition in _conditions(filters or {}, ATTRIBUTES["dim_client"]):
        members = members.where(condition)
    sums = members.groupBy(*by).agg(
        F.count("client_key").alias("nb_clients_distincts"),  # a member has one row
        F.sum("revenu_mensuel").alias("_income"),
        F.count("revenu_mensuel").alias("_n_income"),
        F.sum("score_risque_initial").alias("_score"),
        F.count("score_risque_initial").alias("_n_score"),
    )
    return sums.select(
        *by,
        "nb_clients_distincts",
        ratio("_income", "_n_income").alias("revenu_mensuel_moyen"),
        ratio("_score", "_n_score").alias("score_risque_moyen"),
    )


# --- fixed values: achieved figure, its target, name used in gap and attainment --
COMPARED = (
    ("revenu_realise", "objectif_revenu", "revenu"),
    ("production_credit", "objectif_production_credit", "production_credit"),
    ("nouveaux_clients", "objectif_nouveaux_clients", "nouveaux_clients"),
)


def performance(
    mart: Tables, by: list[str], filters: dict[str, object] | None = None
) -> DataFrame:
    """Achieved against target: revenue (= fees), credit production and new clients.

    Each fact is reduced to the ``by`` grain on its own; the reduced rows are
    stacked and added up, so no fact joins another and a figure without a
    counterpart is kept.
    """

    def reduced(model: Model, *names: str) -> DataFrame:
        return measure(mart, model, list(names), by, model.reachable(filters))

    sources = (
        reduced(TRANSACTIONS, "frais_totaux").withColumnRenamed("frais_totaux", "revenu_realise"),
        reduced(CREDITS, "production_credit"),
        reduced(ENTRIES, "nouveaux_clients"),
        reduced(
            TARGETS, "objectif_revenu", "objectif_nouveaux_clients", "objectif_production_credit"
        ),
    )
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources)
    figures = [c for pair in COMPARED for c in pair[:2]]
    summed = stacked.groupBy(*by).agg(*[F.sum(c).alias(c) for c in figures])
    return summed.select(
        *by,
        *[
            column
            for real, target, name in COMPARED
            for column in (
                _kept(real).alias(real),
                _kept(target).alias(target),
                (_kept(real) - _kept(target)).cast(_kind(real)).alias(f"ecart_{name}"),
                F.try_divide(_kept(real).cast("double"), _kept(target).cast("double")).alias(
                    f"taux_realisation_{name}"
                ),
            )
        ],
    )


def _kind(figure: str) -> str:
    return "bigint" if figure.endswith("nouveaux_clients") else "decimal(38,2)"


def _kept(figure: str) -> Column:
    return F.coalesce(F.col(figure), F.lit(0)).cast(_kind(figure))


def prior_year(monthly: DataFrame, value: str, month: str = "mois_debut", by: list[str] = ()) -> DataFrame:
    """Value of the same month one year before, change and relative change.

    An equality join on the shifted month: gaps in the months do no harm and
    no series has to be gathered in one task.
    """
    before = monthly.select(
        *by,
        F.add_months(month, 12).alias(month),
        F.col(value).alias(f"{value}_annee_precedente"),
    )
    joined = monthly.select(*by, month, value).join(before, [*by, month], "left")
    previous = F.col(f"{value}_annee_precedente")
    return joined.withColumn(f"evolution_{value}", F.col(value) - previous).withColumn(
        f"evolution_{value}_pct",
        F.try_divide(
            (F.col(value) - previous).cast("double"), previous.cast("double")
        ),
    )
