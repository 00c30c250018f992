"""Quality checks of the staging layer, declared per table.

Counted checks are collected per table and layer and computed in one scan
each; checks that compare layers or references are separate plans that reduce
or filter before they join. Every report row is
``(famille, nom_table, controle, valeur, statut)``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions import domains
from ledgerflow.functions import predicates as P
from ledgerflow.functions.dates import french_date, month_boundaries
from ledgerflow.functions.parsing import (
    month_start,
    safe_date,
    safe_decimal,
    safe_int,
    safe_timestamp,
)
from ledgerflow.functions.rules import EN_RETARD, IMPAYE
from ledgerflow.functions.text import blank_to_null, clean_text, message, reference_key
from ledgerflow.operators import grouping
from ledgerflow.operators.bitmaps import totals_and_distincts
from ledgerflow.operators.checks import (
    ATTENTION,
    OK,
    Check,
    count_where,
    run,
    single,
)
from ledgerflow.operators.dedup import first_by
from ledgerflow.operators.lookup import Lookup, orphan_rows, unmatched_counts
from ledgerflow.sources.schemas import RAW_COLUMNS, staging_type

Tables = dict[str, DataFrame]
# Family, check name, condition built on demand, accepted count (None: informative).
Condition = tuple[str, str, Callable[[], Column], int | None]

TABLES = tuple(RAW_COLUMNS)
# Tables whose repeated lines are removed on the way to staging.
DEDUPLICATED = ("clients", "credits", "transactions")

# --- fixed values: mandatory columns ------------------------------------------
MANDATORY_STAGING = {
    "agences": (
        "agence_id", "nom_agence", "ville", "code_postal", "region", "categorie_agence",
    ),
    "objectifs_agences": (
        "agence_id", "mois", "objectif_revenu", "objectif_nouveaux_clients",
        "objectif_production_credit", "seuil_taux_impaye_pct",
    ),
    "produits": (
        "produit_id", "nom_produit", "famille_produit", "univers", "niveau_complexite",
    ),
}
MANDATORY_RAW = {
    "credits": tuple(c for c in RAW_COLUMNS["credits"] if c != "ligne_source"),
    "remboursements": tuple(c for c in RAW_COLUMNS["remboursements"] if c != "date_paiement"),
    "transactions": tuple(c for c in RAW_COLUMNS["transactions"] if c != "produit_id"),
}
# --- fixed values: columns scanned for leftover damaged accents ----------------
ACCENTED = {
    "agences": ("nom_agence", "ville", "departement", "region", "categorie_agence"),
    "clients": ("prenom", "nom", "segment", "profession", "ville", "email", "statut_client"),
    "credits": ("type_credit", "statut_credit"),
    "produits": ("nom_produit", "famille_produit", "univers"),
    "remboursements": ("statut_remboursement",),
    "transactions": ("type_transaction", "sens", "canal", "statut", "devise"),
}


# ------------------------------------------------------------------ conversions
def converted(table: str, column: str) -> Column:
    """The typed value staging derives from a raw column."""
    source, kind = F.col(column), staging_type(table, column)
    if (table, column) == ("objectifs_agences", "mois"):
        return month_start(source)
    if kind.startswith("decimal"):
        precision, scale = (int(n) for n in kind[8:-1].split(","))
        return safe_decimal(source, precision, scale)
    return {"date": safe_date, "int": safe_int, "timestamp_ntz": safe_timestamp}[kind](source)


def failed_column(table: str, column: str) -> Column:
    """The source holds a value that staging could not read."""
    return P.failed_conversion(F.col(column), converted(table, column))


def any_failed(table: str) -> Column:
    typed = [c for c in RAW_COLUMNS[table] if staging_type(table, c) != "string"]
    return P.any_of(*[failed_column(table, c) for c in typed])


# ------------------------------------------------------------------ raw checks
def raw_conditions(table: str) -> list[Condition]:
    found: list[Condition] = []
    typed = [c for c in RAW_COLUMNS[table] if staging_type(table, c) != "string"]
    found.append(("Q2", "conversions_impossibles", lambda: any_failed(table), 0))
    found += [
        ("Q2", f"conversions_impossibles: {c}", lambda c=c: failed_column(table, c), 0) for c in typed
    ]
    if table in MANDATORY_RAW:
        found.append(("Q4", "lignes_source_incompletes", lambda: P.any_blank(*MANDATORY_RAW[table]), 0))
    if table == "remboursements":
        status = clean_text(F.col("statut_remboursement"))
        found += [
            ("Q4", "dates_paiement_absentes", lambda: P.any_blank("date_paiement"), None),
            ("Q5", "remboursement_id_invalides", lambda: _wrong_raw_code("remboursement_id", "R", 8), 0),
            ("Q5", "credit_id_invalides", lambda: _wrong_raw_code("credit_id", "CR", 6), 0),
            ("Q11", "paiements_negatifs_source", lambda: _negative(table, "montant_paye"), None),
            ("Q12", "statuts_non_standardises_source",
             lambda: ~status.isin(*domains.STATUT_REMBOURSEMENT), None),
        ]
    if table == "transactions":
        found.append(("Q4", "produits_absents_source", lambda: P.any_blank("produit_id"), None))
    if table == "credits":
        found.append(("Q11", "taux_negatifs_source", lambda: _negative(table, "taux_annuel"), None))
    if table == "clients":
        found.append(("Q11", "revenus_negatifs_source", lambda: _negative(table, "revenu_mensuel"), None))
    return found


def raw_checks(table: str, families: tuple[str, ...] | None = None) -> list[Check]:
    return [
        Check(family, name, count_where(condition()), limit)
        for family, name, condition, limit in raw_conditions(table)
        if families is None or family in families
    ]


def _wrong_raw_code(column: str, prefix: str, digits: int) -> Column:
    return P.wrong_code(F.upper(blank_to_null(F.col(column))), prefix, digits)


def _negative(table: str, column: str) -> Column:
    return F.coalesce(converted(table, column) < 0, F.lit(False))


# -------------------------------------------------------------- staging checks
def staging_conditions(table: str, as_of: str) -> list[Condition]:
    """(family, check, condition, accepted count): counts and row lists share the condition.

    Conditions are built on demand, so a report over one family only pays for its own.
    """
    c = F.col
    found: list[Condition] = []
    if table in MANDATORY_STAGING:
        found.append(("Q4", "lignes_incompletes", lambda: P.any_null(*MANDATORY_STAGING[table]), 0))
    if table == "agences":
        found += [
            ("Q5", "codes_postaux_invalides", lambda: P.wrong_postcode(c("code_postal")), 0),
            ("Q6", "effectifs_invalides", lambda: P.any_of(c("effectif").isNull(), c("effectif") <= 0), 0),
            ("Q7", "dates_invalides", lambda: c("date_ouverture").isNull() | P.after(c("date_ouverture"), as_of), 0),
            ("Q8", "categories_inconnues", lambda: P.outside_domain(c("categorie_agence"), domains.CATEGORIE_AGENCE), 0),
        ]
    elif table == "clients":
        score = c("score_risque_initial")
        found += [
            ("Q4", "codes_postaux_manquants", lambda: c("code_postal").isNull(), None),
            ("Q4", "emails_manquants", lambda: c("email").isNull(), None),
            ("Q4", "revenus_manquants_ou_invalides", lambda: c("revenu_mensuel").isNull(), None),
            ("Q5", "emails_invalides", lambda: P.wrong_email(c("email")), 0),
            ("Q6", "scores_hors_bornes", lambda: P.any_of(score < 0, score > 100), 0),
            ("Q7", "naissance_apres_entree", lambda: P.any_of(c("date_naissance") > c("date_entree")), 0),
            ("Q7", "valeurs_incoherentes",
             lambda: P.any_of(score < 0, score > 100, c("date_naissance") > c("date_entree")), 0),
            ("Q11", "revenus_negatifs_staging", lambda: P.any_of(c("revenu_mensuel") < 0), 0),
        ]
    elif table == "credits":
        found += [
            ("Q6", "valeurs_numeriques_invalides", lambda: P.any_of(
                c("montant_initial").isNull(), c("montant_initial") <= 0,
                c("taux_annuel") < 0,
                c("duree_mois").isNull(), c("duree_mois") <= 0,
                c("mensualite_theorique").isNull(), c("mensualite_theorique") <= 0,
                c("score_risque_octroi").isNull(),
                c("score_risque_octroi") < 0, c("score_risque_octroi") > 100,
            ), 0),
            ("Q7", "dates_incoherentes", lambda: P.any_of(
                c("date_octroi").isNull(), c("date_fin_prevue").isNull(),
                c("date_fin_prevue") <= c("date_octroi"),
                F.add_months(c("date_octroi"), c("duree_mois")) != c("date_fin_prevue"),
            ), 0),
            ("Q8", "categories_inconnues", lambda: P.any_of(
                P.outside_domain(c("type_credit"), domains.TYPE_CREDIT),
                P.outside_domain(c("statut_credit"), domains.STATUT_CREDIT),
            ), 0),
            ("Q10", "agences_remplacees_par_null", lambda: c("agence_id").isNull(), None),
            ("Q11", "taux_negatifs_staging", lambda: P.any_of(c("taux_annuel") < 0), 0),
            ("Q11", "taux_remplaces_par_null", lambda: c("taux_annuel").isNull(), None),
        ]
    elif table == "objectifs_agences":
        amounts = ("objectif_revenu", "objectif_nouveaux_clients", "objectif_production_credit")
        threshold = c("seuil_taux_impaye_pct")
        found += [
            ("Q5", "formats_agence_invalides", lambda: P.wrong_code(c("agence_id"), "A", 3, null_is_wrong=False), 0),
            ("Q6", "valeurs_numeriques_invalides", lambda: P.any_of(
                P.any_null(*amounts, "seuil_taux_impaye_pct"), *[c(a) < 0 for a in amounts],
                threshold < 0, threshold > 100,
            ), 0),
            ("Q13", "dates_hors_premier_jour", lambda: P.any_of(F.dayofmonth("mois") != 1), 0),
        ]
    elif table == "produits":
        found += [
            ("Q5", "identifiants_invalides", lambda: P.wrong_code(c("produit_id"), "P", 3), 0),
            ("Q6", "niveaux_invalides", lambda: P.outside_range(c("niveau_complexite"), 1, 4), 0),
            ("Q8", "familles_inconnues", lambda: P.outside_domain(c("famille_produit"), domains.FAMILLE_PRODUIT), 0),
            ("Q8", "univers_inconnus", lambda: P.outside_domain(c("univers"), domains.UNIVERS), 0),
        ]
    elif table == "remboursements":
        paid, due = c("montant_paye"), c("montant_attendu")
        late = F.datediff("date_paiement", "date_echeance")
        unpaid = c("statut_remboursement") == IMPAYE
        found += [
            ("Q6", "valeurs_numeriques_invalides", lambda: P.any_of(
                due.isNull(), due <= 0, paid < 0, paid > due,
                c("jours_retard").isNull(), c("jours_retard") < 0,
            ), 0),
            ("Q7", "retards_calcules_incoherents", lambda: P.any_of(
                c("date_paiement").isNotNull()
                & (c("jours_retard") != F.when(late > 0, late).otherwise(0))
            ), 0),
            ("Q7", "impayes_incoherents", lambda: P.any_of(
                unpaid & (c("date_paiement").isNotNull() | (paid != 0) | (c("jours_retard") <= 0))
            ), 0),
            ("Q7", "nombre_impayes", lambda: P.any_of(unpaid), None),
            ("Q8", "statuts_inconnus_staging",
             lambda: P.outside_domain(c("statut_remboursement"), domains.STATUT_REMBOURSEMENT), 0),
            ("Q11", "paiements_negatifs_staging", lambda: P.any_of(paid < 0), 0),
            ("Q17", "paiements_complets", lambda: P.any_of(paid == due), None),
            ("Q17", "paiements_partiels", lambda: P.any_of((paid > 0) & (paid < due)), None),
            ("Q17", "paiements_nuls", lambda: P.any_of(paid == 0), None),
            ("Q17", "paiements_invalides_null", lambda: paid.isNull(), None),
        ]
    elif table == "transactions":
        amount, fee, side = c("montant"), c("frais"), c("sens")
        banking = c("type_transaction") == "Frais bancaires"
        wrong_sign = ((side == "Débit") & (amount >= 0)) | ((side == "Crédit") & (amount <= 0))
        found += [
            ("Q4", "produits_absents_staging", lambda: c("produit_id").isNull(), None),
            ("Q5", "transaction_id_invalides", lambda: P.wrong_code(c("transaction_id"), "T", 9), 0),
            ("Q5", "client_id_invalides", lambda: P.wrong_code(c("client_id"), "C", 6), 0),
            ("Q5", "produit_id_invalides", lambda: P.wrong_code(c("produit_id"), "P", 3, null_is_wrong=False), 0),
            ("Q5", "agence_id_invalides", lambda: P.wrong_code(c("agence_id"), "A", 3, null_is_wrong=False), 0),
            ("Q7", "dates_nulles_staging", lambda: c("date_transaction").isNull(), None),
            ("Q8", "types_inconnus", lambda: P.outside_domain(c("type_transaction"), domains.TYPE_TRANSACTION), 0),
            ("Q8", "canaux_inconnus", lambda: P.outside_domain(c("canal"), domains.CANAL), 0),
            ("Q8", "statuts_inconnus", lambda: P.outside_domain(c("statut"), domains.STATUT_TRANSACTION), 0),
            ("Q8", "devises_inconnues", lambda: P.outside_domain(c("devise"), domains.DEVISE), 0),
            ("Q10", "clients_null_staging", lambda: c("client_id").isNull(), None),
            ("Q10", "agences_remplacees_par_null", lambda: c("agence_id").isNull(), None),
            ("Q15", "nombre_debits", lambda: P.any_of(side == "Débit"), None),
            ("Q15", "nombre_credits", lambda: P.any_of(side == "Crédit"), None),
            ("Q15", "montants_nuls_ou_absents", lambda: P.any_of(amount.isNull(), amount == 0), 0),
            ("Q15", "montants_sens_incoherents", lambda: P.any_of(wrong_sign), 0),
            ("Q15", "sens_inconnus", lambda: P.outside_domain(side, domains.SENS), 0),
            ("Q16", "operations_avec_frais", lambda: P.any_of(fee > 0), None),
            ("Q16", "frais_negatifs_ou_absents", lambda: P.any_of(fee.isNull(), fee < 0), 0),
            ("Q16", "frais_hors_operation_bancaire", lambda: P.any_of((fee > 0) & ~banking), 0),
            ("Q16", "operations_frais_sans_frais", lambda: P.any_of(banking & (fee.isNull() | (fee <= 0))), 0),
        ]
    if table in ACCENTED:
        found.append(("Q9", "encodages_incorrects", lambda: P.mojibake(*ACCENTED[table]), 0))
    return found


def staging_checks(
    table: str, as_of: str, families: tuple[str, ...] | None = None
) -> list[Check]:
    return [
        Check(family, name, count_where(condition()), limit)
        for family, name, condition, limit in staging_conditions(table, as_of)
        if families is None or family in families
    ]


def counted(
    raw: Tables, staging: Tables, as_of: str, families: tuple[str, ...] | None = None
) -> DataFrame:
    """All counted checks (or those of some families): one scan per table and layer."""
    parts = []
    for table in TABLES:
        for layer, frames, checks in (
            ("raw", raw, raw_checks(table, families)),
            ("staging", staging, staging_checks(table, as_of, families)),
        ):
            if checks:
                parts.append(run(frames[table], f"{layer}.{table}", checks))
    return _union(parts)


def offenders(
    staging: Tables, table: str, check: str, as_of: str, order: list[str], n: int | None = None
) -> DataFrame:
    """Rows of a staging table that fail a counted check: all, or the first ``n`` in order."""
    conditions = {name: condition for _, name, condition, _ in staging_conditions(table, as_of)}
    return grouping.listed(staging[table].where(conditions[check]()), n, *order)


def raw_offenders(raw: Tables, table: str, check: str, order: list[str], n: int | None = None) -> DataFrame:
    """Rows of a raw table that fail a counted check: all, or the first ``n`` in order."""
    conditions = {name: condition for _, name, condition, _ in raw_conditions(table)}
    return grouping.listed(raw[table].where(conditions[check]()), n, *order)


def conversion_offenders(raw: Tables, table: str, order: list[str], n: int | None = None) -> DataFrame:
    typed = [c for c in RAW_COLUMNS[table] if staging_type(table, c) != "string"]
    keys = [c for c in order if c not in typed]
    return grouping.listed(raw[table].where(any_failed(table)).select(*keys, *typed), n, *order)


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.union, parts)


# ------------------------------------------------------------ Q1 reconciliation
def row_counts(raw: Tables, staging: Tables) -> DataFrame:
    """Rows in, rows out, and the sentence that goes with them."""
    parts = []
    for table in TABLES:
        counts = staging[table].agg(F.count(F.lit(1)).alias("lignes_staging")).select(
            F.lit(table).alias("nom_table"),
            raw[table].agg(F.count(F.lit(1))).scalar().alias("lignes_raw"),
            "lignes_staging",
        )
        removed = F.col("lignes_raw") - F.col("lignes_staging")
        accepted = removed >= 0 if table in DEDUPLICATED else removed == 0
        sentence = (
            message(f"{table} : ", F.col("lignes_staging"), " lignes uniques, ", removed,
                    " répétition(s) écartée(s).")
            if table in DEDUPLICATED
            else message(f"{table} : ", F.col("lignes_raw"), " lignes, aucune perdue.")
        )
        warning = message(f"{table} : ", F.abs(removed), " ligne(s) d’écart.")
        parts.append(
            counts.select(
                "*",
                removed.alias("lignes_retirees"),
                F.when(accepted, OK).otherwise(ATTENTION).alias("statut"),
                F.when(accepted, sentence).otherwise(warning).alias("conclusion"),
            )
        )
    return _union(parts)


# ---------------------------------------------------------------- Q3 duplicates
def duplicate_keys() -> dict[tuple[str, str], dict[str, Column]]:
    """(layer, table) -> business key whose repetition is counted."""
    c = F.col
    return {
        ("staging", "agences"): {"agence_id": c("agence_id")},
        ("raw", "clients"): {"client_id": blank_to_null(c("client_id"))},
        ("raw", "credits"): {"credit_id": blank_to_null(c("credit_id"))},
        ("staging", "objectifs_agences"): {"agence_id": c("agence_id"), "mois": c("mois")},
        ("staging", "produits"): {"produit_id": c("produit_id")},
        ("staging", "remboursements"): {"remboursement_id": c("remboursement_id")},
        ("raw", "transactions"): {"transaction_id": blank_to_null(c("transaction_id"))},
        ("staging", "transactions"): {"transaction_id": c("transaction_id")},
    }


def duplicate_report(raw: Tables, staging: Tables) -> DataFrame:
    layers = {"raw": raw, "staging": staging}
    return _union(
        [
            single(
                grouping.duplicate_summary(layers[layer][table], keys),
                "Q3",
                f"{layer}.{table}",
                None if layer == "raw" else 0,
            )
            for (layer, table), keys in duplicate_keys().items()
        ]
    )


def duplicate_list(raw: Tables, staging: Tables, layer: str, table: str, n: int | None = None) -> DataFrame:
    keys = duplicate_keys()[(layer, table)]
    frame = {"raw": raw, "staging": staging}[layer][table]
    return grouping.listed(grouping.duplicates(frame, keys), n, F.desc(grouping.COUNT), *keys)


# ------------------------------------------------------- Q10 orphan references
# --- fixed values: (layer, table, column, raw reference table, reference column)
REFERENCES = (
    ("staging", "clients", "agence_id", "agences", "agence_id"),
    ("raw", "credits", "agence_id", "agences", "agence_id"),
    ("raw", "credits", "client_id", "clients", "client_id"),
    ("staging", "objectifs_agences", "agence_id", "agences", "agence_id"),
    ("raw", "remboursements", "credit_id", "credits", "credit_id"),
    ("raw", "transactions", "client_id", "clients", "client_id"),
    ("raw", "transactions", "produit_id", "produits", "produit_id"),
    ("raw", "transactions", "agence_id", "agences", "agence_id"),
)


def orphan_report(raw: Tables, staging: Tables) -> DataFrame:
    """Rows whose given identifier has no reference, counted per identifier before the anti join."""
    layers = {"raw": raw, "staging": staging}
    grouped: dict[tuple[str, str], list[Lookup]] = {}
    for layer, table, column, ref, _ in REFERENCES:
        # A missing identifier is not an orphan: it is matched with itself.
        given = f"coalesce(upper(nullif(trim({column}), '')), '')"
        label = f"{layer}.{table}/{column}_orphelins"
        grouped.setdefault((layer, table), []).append(Lookup(label, ref, given))
    members = {}
    for *_, ref, ref_column in REFERENCES:
        if ref not in members:
            key = f"coalesce(upper(nullif(trim({ref_column}), '')), '')"
            given = raw[ref].selectExpr(f"{key} as _ref")
            blank = raw[ref].sparkSession.range(1).selectExpr("'' as _ref")
            members[ref] = given.union(blank).distinct()
    sources = [(layers[layer][table], lookups) for (layer, table), lookups in grouped.items()]
    return unmatched_counts(sources, members).selectExpr(
        "'Q10' as famille",
        "split_part(cle, '/', 1) as nom_table",
        "split_part(cle, '/', 2) as controle",
        "lignes as valeur",
        f"case when lignes = 0 then '{OK}' else '{ATTENTION}' end as statut",
    )


def orphan_list(
    raw: Tables, staging: Tables, layer: str, table: str, column: str, key: str, n: int | None = None
) -> DataFrame:
    _, _, _, ref, ref_column = next(
        r for r in REFERENCES if (r[0], r[1], r[2]) == (layer, table, column)
    )
    frame = {"raw": raw, "staging": staging}[layer][table]
    found = orphan_rows(frame, column, raw[ref], ref_column)
    return grouping.listed(found.select(key, column), n, key, column)


def orphan_changes(raw: Tables, staging: Tables, table: str, column: str, key: str) -> DataFrame:
    """Orphan identifiers of a raw table next to what staging made of them (NULL)."""
    before = orphan_list(raw, staging, "raw", table, column, key).select(
        reference_key(F.col(key)).alias("_key"), F.col(column).alias(f"{column}_avant")
    )
    after = staging[table].select(F.col(key), F.col(column).alias(f"{column}_apres"))
    return before.join(after, F.col("_key") == F.upper(key)).select(key, f"{column}_avant", f"{column}_apres")


# --------------------------------------------------- Q11 negatives become NULL
# --- fixed values: table -> (business key, amount that cannot be negative)
NEGATIVES = {
    "clients": ("client_id", "revenu_mensuel"),
    "credits": ("credit_id", "taux_annuel"),
    "remboursements": ("remboursement_id", "montant_paye"),
}


def negatives(raw: Tables, staging: Tables, table: str) -> DataFrame:
    """Negative source values next to their staging value; only those source rows are joined."""
    key, column = NEGATIVES[table]
    source = raw[table].where(_negative(table, column)).select(
        reference_key(F.col(key)).alias("_key"), converted(table, column).alias("valeur_source")
    )
    after = staging[table].select(F.col(key), F.col(column).alias("valeur_staging"))
    return source.join(after, F.col("_key") == F.upper(key)).select(
        key, "valeur_source", "valeur_staging"
    )


def negative_report(raw: Tables, staging: Tables) -> DataFrame:
    return _union(
        [
            single(
                negatives(raw, staging, table).agg(
                    F.count(F.lit(1)).alias("negatifs_rapproches"),
                    F.count_if(F.col("valeur_staging").isNull()).alias("remplaces_par_null"),
                ),
                "Q11",
                f"raw-staging.{table}",
                None,
            )
            for table in NEGATIVES
        ]
    )


# ------------------------------------------------------ Q12 changes by cleaning
def _paired(raw: Tables, staging: Tables, table: str, key: str, columns: tuple[str, ...],
            first_line: bool) -> DataFrame:
    """Raw and staging rows side by side: ``<c>_avant`` (text as received) and ``<c>_apres``.

    With ``first_line`` only the first source line of an identifier is
    compared, as deduplication keeps that one.
    """
    before = raw[table].withColumn("_key", reference_key(F.col(key)))
    if first_line:
        known = before.where(F.col("_key").isNotNull())
        rest = [F.col(c) for c in RAW_COLUMNS[table] if c not in ("ligne_source", key)]
        before = first_by(known, F.col("_key"), [safe_int(F.col("ligne_source")), *rest])
    before = before.select("_key", *[F.col(c).alias(f"{c}_avant") for c in columns])
    after = staging[table].select(key, *[F.col(c).alias(f"{c}_apres") for c in columns])
    return before.join(after, F.col("_key") == F.upper(key)).drop("_key")


def changes(raw: Tables, staging: Tables, table: str) -> DataFrame:
    """Rows with at least one text changed by cleaning, before and after."""
    key, columns, first_line, cleaned, exact = CHANGES[table]
    pairs = _paired(raw, staging, table, key, columns, first_line)
    changed = [_changed(c, cleaned, exact) for c in columns]
    return pairs.where(P.any_of(*changed)).select(
        key, *[f"{c}_{side}" for c in columns for side in ("avant", "apres")]
    )


def change_report(raw: Tables, staging: Tables) -> DataFrame:
    """Per table: rows changed, and changes per column."""
    parts = []
    for table, (key, columns, first_line, cleaned, exact) in CHANGES.items():
        changed = {c: _changed(c, cleaned, exact) for c in columns}
        total = _paired(raw, staging, table, key, columns, first_line).agg(
            F.count_if(P.any_of(*changed.values())).alias("lignes_modifiees"),
            *[F.count_if(bad).alias(f"{c}_modifies") for c, bad in changed.items()],
        )
        parts.append(single(total, "Q12", f"raw-staging.{table}", None))
    return _union(parts)


def _changed(column: str, cleaned: bool, exact: bool) -> Column:
    """``cleaned`` ignores what text repair alone did; ``exact`` ignores missing values."""
    source, after = F.col(f"{column}_avant"), F.col(f"{column}_apres")
    before = clean_text(source) if cleaned else blank_to_null(source)
    if column == "devise":
        before = F.upper(before)
    return P.differs(before, after) if exact else P.differs_or_missing(before, after)


# --- fixed values: key, compared columns, first line only, cleaned first, exact
CHANGES = {
    "agences": ("agence_id", ("nom_agence", "ville", "departement", "region", "categorie_agence"), False, False, False),
    "clients": ("client_id", ("prenom", "profession", "segment", "ville", "email"), True, False, False),
    "credits": ("credit_id", ("type_credit", "statut_credit"), False, True, False),
    "produits": ("produit_id", ("nom_produit", "famille_produit", "univers"), False, True, False),
    "remboursements": ("remboursement_id", ("statut_remboursement",), False, True, True),
    "transactions": ("transaction_id", ("type_transaction", "sens", "canal", "statut", "devise"), True, True, True),
}


def target_pairs(raw: Tables, staging: Tables) -> DataFrame:
    """Targets before and after typing, matched on branch and month."""
    values = ("objectif_revenu", "objectif_nouveaux_clients", "objectif_production_credit", "seuil_taux_impaye_pct")
    before = raw["objectifs_agences"].select(
        blank_to_null(F.col("agence_id")).alias("agence_id"),
        month_start(F.col("mois")).alias("mois"),
        *[F.col(v).alias(f"{v}_texte") for v in values],
    )
    after = staging["objectifs_agences"].select("agence_id", "mois", *values)
    return before.join(after, ["agence_id", "mois"])


def impossible_dates(raw: Tables, staging: Tables) -> DataFrame:
    """Operations whose date could not be read, with what was received."""
    bad = raw["transactions"].where(failed_column("transactions", "date_transaction")).select(
        reference_key(F.col("transaction_id")).alias("_key"),
        F.col("date_transaction").alias("date_source"),
    )
    after = staging["transactions"].select(
        "transaction_id", F.col("date_transaction").alias("date_apres")
    )
    return bad.join(after, F.col("_key") == F.col("transaction_id")).select(
        "transaction_id", "date_source", "date_apres"
    )


# ------------------------------------------------------------ Q13, Q14 calendar
def month_continuity(staging: Tables) -> DataFrame:
    """Distinct months against the span between the first and the last."""
    months = staging["objectifs_agences"].agg(
        F.min("mois").alias("premier_mois"),
        F.max("mois").alias("dernier_mois"),
        F.countDistinct("mois").alias("mois_distincts"),
        F.count_if(F.dayofmonth("mois") != 1).alias("dates_hors_premier_jour"),
    )
    wanted = month_boundaries(F.col("premier_mois"), F.col("dernier_mois")) + 1
    good = (F.col("mois_distincts") == wanted) & (F.col("dates_hors_premier_jour") == 0)
    return months.select(
        "premier_mois",
        "dernier_mois",
        "mois_distincts",
        wanted.cast("bigint").alias("mois_attendus"),
        "dates_hors_premier_jour",
        F.when(good, OK).otherwise(ATTENTION).alias("statut"),
    )


def grid(staging: Tables) -> DataFrame:
    """Is every branch followed in every month?"""
    targets = staging["objectifs_agences"]
    totals = totals_and_distincts(
        targets, {"lignes_reelles": F.lit(1)}, {"agences_distinctes": "agence_id", "mois_distincts": "mois"}
    ).select("agences_distinctes", "mois_distincts", _counted("lignes_reelles"))
    branches = branch_gaps(staging).agg(F.count(F.lit(1)))
    months = month_gaps(staging).agg(F.count(F.lit(1)))
    wanted = F.col("agences_distinctes") * F.col("mois_distincts")
    good = (
        (F.col("lignes_reelles") == wanted)
        & (F.col("agences_periode_incomplete") == 0)
        & (F.col("mois_agences_incompletes") == 0)
    )
    return totals.select(
        "*",
        wanted.alias("lignes_theoriques"),
        branches.scalar().alias("agences_periode_incomplete"),
        months.scalar().alias("mois_agences_incompletes"),
    ).withColumn("statut", F.when(good, OK).otherwise(ATTENTION))


def _counted(figure: str) -> Column:
    """A sum of ones: 0 over no rows."""
    return F.coalesce(F.col(figure), F.lit(0)).cast("bigint").alias(figure)


def branch_gaps(staging: Tables) -> DataFrame:
    return grouping.coverage_gaps(
        staging["objectifs_agences"], "agence_id", "mois", "nombre_mois_disponibles", "nombre_mois_attendus"
    )


def month_gaps(staging: Tables) -> DataFrame:
    return grouping.coverage_gaps(
        staging["objectifs_agences"], "mois", "agence_id", "nombre_agences_disponibles", "nombre_agences_attendues"
    )


# ------------------------------------------------------- Q17 payment split, Q18
def payment_split(staging: Tables) -> DataFrame:
    """Full, partial, zero and invalid payments; they should add up to all instalments."""
    paid, due = F.col("montant_paye"), F.col("montant_attendu")
    parts = {
        "paiements_complets": paid == due,
        "paiements_partiels": (paid > 0) & (paid < due),
        "echeances_impayees": paid == 0,
        "montants_invalides_null": paid.isNull(),
    }
    split = staging["remboursements"].agg(
        *[F.count_if(P.any_of(condition)).alias(name) for name, condition in parts.items()],
        F.count(F.lit(1)).alias("total_echeances"),
    )
    added = reduce(lambda a, b: a + b, [F.col(name) for name in parts])
    return split.withColumn(
        "statut", F.when(added == F.col("total_echeances"), OK).otherwise(ATTENTION)
    )


def target_ranges(staging: Tables) -> DataFrame:
    values = ("objectif_revenu", "objectif_nouveaux_clients", "objectif_production_credit", "seuil_taux_impaye_pct")
    return staging["objectifs_agences"].agg(
        *[f(v).alias(f"{v}_{name}") for v in values for f, name in ((F.min, "minimum"), (F.max, "maximum"))]
    )


def repayment_ranges(staging: Tables) -> DataFrame:
    bounds = {
        "premiere_echeance": F.min("date_echeance"),
        "derniere_echeance": F.max("date_echeance"),
        "premier_paiement": F.min("date_paiement"),
        "dernier_paiement": F.max("date_paiement"),
        "retard_minimum": F.min("jours_retard"),
        "retard_maximum": F.max("jours_retard"),
    }
    sentence = message(
        "Échéances du ", french_date(F.col("premiere_echeance")), " au ",
        french_date(F.col("derniere_echeance")), ", retards de ",
        F.col("retard_minimum"), " à ", F.col("retard_maximum"), " jours.",
    )
    return (
        staging["remboursements"]
        .agg(*[c.alias(name) for name, c in bounds.items()])
        .withColumn("conclusion", sentence)
    )


def extremes(staging: Tables) -> DataFrame:
    """Bounds quoted by the range and date checks, as text so they share one column."""
    wanted = (
        ("agences", "effectif"),
        ("agences", "date_ouverture"),
        ("produits", "niveau_complexite"),
        ("transactions", "date_transaction"),
    )
    return _union(
        [
            staging[t].agg(
                F.min(c).cast("string").alias("minimum"), F.max(c).cast("string").alias("maximum")
            ).select(F.lit(t).alias("nom_table"), F.lit(c).alias("colonne"), "minimum", "maximum")
            for t, c in wanted
        ]
    )


# ---------------------------------------------------------- Q19 distributions
def distribution(df: DataFrame, *keys: str, count: str = "nombre", **sums: str) -> DataFrame:
    """Count and sums per label."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(count),
        *[F.sum(c).cast("decimal(38,2)").alias(name) for name, c in sums.items()],
    )


def label_distributions(staging: Tables) -> DataFrame:
    """Every one-label distribution in a single report."""
    wanted = (
        ("agences", "categorie_agence"),
        ("credits", "type_credit"),
        ("credits", "statut_credit"),
        ("produits", "niveau_complexite"),
        ("produits", "famille_produit"),
        ("produits", "univers"),
        ("remboursements", "statut_remboursement"),
        ("transactions", "statut"),
    )
    return _union(
        [
            distribution(staging[t], c).select(
                F.lit(t).alias("nom_table"),
                F.lit(c).alias("colonne"),
                F.col(c).cast("string").alias("valeur"),
                "nombre",
            )
            for t, c in wanted
        ]
    )


def targets_by_year(staging: Tables) -> DataFrame:
    return (
        staging["objectifs_agences"]
        .groupBy(F.year("mois").alias("annee"))
        .agg(
            F.count(F.lit(1)).alias("nombre_lignes"),
            F.countDistinct("agence_id").alias("nombre_agences"),
            F.countDistinct("mois").alias("nombre_mois"),
        )
    )


# ------------------------------------------------------------- Q20 summaries
def final_summaries(staging: Tables) -> DataFrame:
    """Closing figures of every table as (table, figure, value) rows."""
    wanted = {
        "credits": {"total_credits": F.count(F.lit(1))},
        "remboursements": {
            "total_echeances": F.count(F.lit(1)),
            "total_impayes": F.count_if(F.col("statut_remboursement") == IMPAYE),
            "total_paiements_en_retard": F.count_if(F.col("statut_remboursement") == EN_RETARD),
        },
        "transactions": {
            "total_transactions": F.count(F.lit(1)),
            "clients_distincts": F.countDistinct("client_id"),
            "dates_impossibles_null": F.count_if(F.col("date_transaction").isNull()),
            "produits_absents_null": F.count_if(F.col("produit_id").isNull()),
            "agences_orphelines_null": F.count_if(F.col("agence_id").isNull()),
        },
    }
    # Several distinct counts of one table, without a copy of its rows for each.
    several = {
        "objectifs_agences": ("total_objectifs", {"total_agences": "agence_id", "total_mois": "mois"}),
        "produits": ("total_produits", {"total_familles": "famille_produit", "total_univers": "univers"}),
    }
    rows = {t: staging[t].agg(*[c.alias(name) for name, c in figures.items()]) for t, figures in wanted.items()}
    for t, (total, distincts) in several.items():
        counted = totals_and_distincts(staging[t], {total: F.lit(1)}, distincts)
        rows[t] = counted.select(_counted(total), *distincts)
    return _union([single(row, "Q20", f"staging.{t}", None) for t, row in rows.items()])


# --- fixed values: order of the closing previews -------------------------------
PREVIEW_ORDER = {
    "agences": ("agence_id",),
    "clients": ("client_id",),
    "credits": ("credit_id",),
    "objectifs_agences": ("agence_id", "mois"),
    "produits": ("produit_id",),
    "remboursements": ("remboursement_id",),
    "transactions": ("transaction_id",),
}


def preview(staging: Tables, table: str, n: int = 20) -> DataFrame:
    return grouping.top(staging[table], n, *PREVIEW_ORDER[table])


def full_report(raw: Tables, staging: Tables, as_of: str) -> DataFrame:
    """Every check that yields counts, over all tables."""
    return _union(
        [
            counted(raw, staging, as_of),
            duplicate_report(raw, staging),
            orphan_report(raw, staging),
            negative_report(raw, staging),
            change_report(raw, staging),
        ]
    )
