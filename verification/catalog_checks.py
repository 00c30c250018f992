"""Registered queries: quality families, model controls, summaries, measures and reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.operators.checks import unpivot
from ledgerflow.plans import controls, quality, reports, summaries
from ledgerflow.plans import measures as M
from ledgerflow.sources.schemas import RAW_COLUMNS, STAGING_TYPES
from verification import oracle as O
from verification.catalog import AS_OF, BAND, LEVEL, register
from verification.context import Context

b2n, inlist = O.b2n, O.inlist


# ======================================================= Q: counted quality checks
def _typed(table: str, column: str) -> str:
    kind = STAGING_TYPES[table][column]
    if (table, column) == ("objectifs_agences", "mois"):
        return O.smonth(column)
    if kind.startswith("decimal"):
        p, s = (int(v) for v in kind[8:-1].split(","))
        return O.sdec(column, p, s)
    return {"date": O.sdate, "int": O.sint, "timestamp_ntz": O.sts}[kind](column)


def _failed(table: str, column: str) -> str:
    return f"({b2n(column)} is not null and ({_typed(table, column)}) is null)"


def _blank(columns: list[str]) -> str:
    return " or ".join(f"{b2n(c)} is null" for c in columns)


def _nulls(*columns: str) -> str:
    return " or ".join(f"{c} is null" for c in columns)


def _outside(column: str, labels: list[str]) -> str:
    return f"{column} is null or {column} not in {inlist(labels)}"


def _code(column: str, pattern: str, null_is_wrong: bool = True) -> str:
    wrong = f"not regexp_full_match({column}, '{pattern}')"
    return f"({column} is null or {wrong})" if null_is_wrong else f"({column} is not null and {wrong})"


def _traces(*columns: str) -> str:
    text = f"concat_ws('', {', '.join(columns)})"
    return " or ".join(f"{text} like '%{t}%'" for t in "├√Ã")


def _raw_conditions() -> list[tuple[str, str, str, str, int | None]]:
    out: list[tuple[str, str, str, str, int | None]] = []
    for table, types in STAGING_TYPES.items():
        columns = [c for c in RAW_COLUMNS[table] if c in types]
        every = " or ".join(_failed(table, c) for c in columns)
        out.append((f"raw.{table}", "Q2", "conversions_impossibles", every, 0))
        out += [(f"raw.{table}", "Q2", f"conversions_impossibles: {c}", _failed(table, c), 0) for c in columns]
    for table, optional in (("credits", "ligne_source"), ("remboursements", "date_paiement"), ("transactions", "produit_id")):
        needed = [c for c in RAW_COLUMNS[table] if c != optional]
        out.append((f"raw.{table}", "Q4", "lignes_source_incompletes", _blank(needed), 0))
    r = "raw.remboursements"
    out += [
        (r, "Q4", "dates_paiement_absentes", f"{b2n('date_paiement')} is null", None),
        (r, "Q5", "remboursement_id_invalides", _code(f"upper({b2n('remboursement_id')})", "R[0-9]{8}"), 0),
        (r, "Q5", "credit_id_invalides", _code(f"upper({b2n('credit_id')})", "CR[0-9]{6}"), 0),
        (r, "Q11", "paiements_negatifs_source", f"({O.sdec('montant_paye', 15, 2)}) < 0", None),
        (r, "Q12", "statuts_non_standardises_source", f"{O.clean('statut_remboursement')} not in {inlist(O.STATUTS_REMB)}", None),
        ("raw.transactions", "Q4", "produits_absents_source", f"{b2n('produit_id')} is null", None),
        ("raw.credits", "Q11", "taux_negatifs_source", f"({O.sdec('taux_annuel', 6, 3)}) < 0", None),
        ("raw.clients", "Q11", "revenus_negatifs_source", f"({O.sdec('revenu_mensuel', 12, 2)}) < 0", None),
    ]
    return out


def _staging_conditions() -> list[tuple[str, str, str, str, int | None]]:
    late = "greatest(date_diff('day', date_echeance, date_paiement), 0)"
    ag, cl, cr, ob, pr, re_, tr = (
        f"staging.{t}" for t in ("agences", "clients", "credits", "objectifs_agences", "produits", "remboursements", "transactions")
    )
    return [
        (ag, "Q4", "lignes_incompletes", _nulls("agence_id", "nom_agence", "ville", "code_postal", "region", "categorie_agence"), 0),
        (ag, "Q5", "codes_postaux_invalides", "code_postal is not null and (length(code_postal) <> 5 or regexp_matches(code_postal, '[^0-9]'))", 0),
        (ag, "Q6", "effectifs_invalides", "effectif is null or effectif <= 0", 0),
        (ag, "Q7", "dates_invalides", f"date_ouverture is null or date_ouverture > date '{AS_OF}'", 0),
        (ag, "Q8", "categories_inconnues", _outside("categorie_agence", O.CATEGORIES), 0),
        (ag, "Q9", "encodages_incorrects", _traces("nom_agence", "ville", "departement", "region", "categorie_agence"), 0),
        (cl, "Q4", "codes_postaux_manquants", "code_postal is null", None),
        (cl, "Q4", "emails_manquants", "email is null", None),
        (cl, "Q4", "revenus_manquants_ou_invalides", "revenu_mensuel is null", None),
        (cl, "Q5", "emails_invalides", "email is not null and (email not like '%@%.%' or email like '% %')", 0),
        (cl, "Q6", "scores_hors_bornes", "score_risque_initial < 0 or score_risque_initial > 100", 0),
        (cl, "Q7", "naissance_apres_entree", "date_naissance > date_entree", 0),
        (cl, "Q7", "valeurs_incoherentes", "score_risque_initial < 0 or score_risque_initial > 100 or date_naissance > date_entree", 0),
        (cl, "Q9", "encodages_incorrects", _traces("prenom", "nom", "segment", "profession", "ville", "email", "statut_client"), 0),
        (cl, "Q11", "revenus_negatifs_staging", "revenu_mensuel < 0", 0),
        (cr, "Q6", "valeurs_numeriques_invalides", "montant_initial is null or montant_initial <= 0 or taux_annuel < 0 or duree_mois is null"
         " or duree_mois <= 0 or mensualite_theorique is null or mensualite_theorique <= 0 or score_risque_octroi is null"
         " or score_risque_octroi < 0 or score_risque_octroi > 100", 0),
        (cr, "Q7", "dates_incoherentes", "date_octroi is null or date_fin_prevue is null or date_fin_prevue <= date_octroi"
         " or cast(date_octroi + to_months(duree_mois) as date) <> date_fin_prevue", 0),
        (cr, "Q8", "categories_inconnues", f"{_outside('type_credit', O.TYPES_CREDIT)} or {_outside('statut_credit', O.STATUTS_CREDIT)}", 0),
        (cr, "Q9", "encodages_incorrects", _traces("type_credit", "statut_credit"), 0),
        (cr, "Q10", "agences_remplacees_par_null", "agence_id is null", None),
        (cr, "Q11", "taux_negatifs_staging", "taux_annuel < 0", 0),
        (cr, "Q11", "taux_remplaces_par_null", "taux_annuel is null", None),
        (ob, "Q4", "lignes_incompletes", _nulls(*RAW_COLUMNS["objectifs_agences"]), 0),
        (ob, "Q5", "formats_agence_invalides", _code("agence_id", "A[0-9]{3}", False), 0),
        (ob, "Q6", "valeurs_numeriques_invalides", _nulls("objectif_revenu", "objectif_nouveaux_clients", "objectif_production_credit", "seuil_taux_impaye_pct")
         + " or objectif_revenu < 0 or objectif_nouveaux_clients < 0 or objectif_production_credit < 0"
           " or seuil_taux_impaye_pct < 0 or seuil_taux_impaye_pct > 100", 0),
        (ob, "Q13", "dates_hors_premier_jour", "day(mois) <> 1", 0),
        (pr, "Q4", "lignes_incompletes", _nulls(*RAW_COLUMNS["produits"]), 0),
        (pr, "Q5", "identifiants_invalides", _code("produit_id", "P[0-9]{3}"), 0),
        (pr, "Q6", "niveaux_invalides", "niveau_complexite is null or niveau_complexite not between 1 and 4", 0),
        (pr, "Q8", "familles_inconnues", _outside("famille_produit", O.FAMILLES), 0),
        (pr, "Q8", "univers_inconnus", _outside("univers", O.UNIVERS), 0),
        (pr, "Q9", "encodages_incorrects", _traces("nom_produit", "famille_produit", "univers"), 0),
        (re_, "Q6", "valeurs_numeriques_invalides", "montant_attendu is null or montant_attendu <= 0 or montant_paye < 0"
         " or montant_paye > montant_attendu or jours_retard is null or jours_retard < 0", 0),
        (re_, "Q7", "retards_calcules_incoherents", f"date_paiement is not null and jours_retard <> case when date_echeance is null then 0 else {late} end", 0),
        (re_, "Q7", "impayes_incoherents", "statut_remboursement = 'Impayé' and (date_paiement is not null or montant_paye <> 0 or jours_retard <= 0)", 0),
        (re_, "Q7", "nombre_impayes", "statut_remboursement = 'Impayé'", None),
        (re_, "Q8", "statuts_inconnus_staging", _outside("statut_remboursement", O.STATUTS_REMB), 0),
        (re_, "Q9", "encodages_incorrects", _traces("statut_remboursement"), 0),
        (re_, "Q11", "paiements_negatifs_staging", "montant_paye < 0", 0),
        (re_, "Q17", "paiements_complets", "montant_paye = montant_attendu", None),
        (re_, "Q17", "paiements_partiels", "montant_paye > 0 and montant_paye < montant_attendu", None),
        (re_, "Q17", "paiements_nuls", "montant_paye = 0", None),
        (re_, "Q17", "paiements_invalides_null", "montant_paye is null", None),
        (tr, "Q4", "produits_absents_staging", "produit_id is null", None),
        (tr, "Q5", "transaction_id_invalides", _code("transaction_id", "T[0-9]{9}"), 0),
        (tr, "Q5", "client_id_invalides", _code("client_id", "C[0-9]{6}"), 0),
        (tr, "Q5", "produit_id_invalides", _code("produit_id", "P[0-9]{3}", False), 0),
        (tr, "Q5", "agence_id_invalides", _code("agence_id", "A[0-9]{3}", False), 0),
        (tr, "Q7", "dates_nulles_staging", "date_transaction is null", None),
        (tr, "Q8", "types_inconnus", _outside("type_transaction", O.TYPES_TRANS), 0),
        (tr, "Q8", "canaux_inconnus", _outside("canal", O.CANAUX), 0),
        (tr, "Q8", "statuts_inconnus", _outside("statut", O.STATUTS_TRANS), 0),
        (tr, "Q8", "devises_inconnues", "devise is null or devise <> 'EUR'", 0),
        (tr, "Q9", "encodages_incorrects", _traces("type_transaction", "sens", "canal", "statut", "devise"), 0),
        (tr, "Q10", "clients_null_staging", "client_id is null", None),
        (tr, "Q10", "agences_remplacees_par_null", "agence_id is null", None),
        (tr, "Q15", "nombre_debits", "sens = 'Débit'", None),
        (tr, "Q15", "nombre_credits", "sens = 'Crédit'", None),
        (tr, "Q15", "montants_nuls_ou_absents", "montant is null or montant = 0", 0),
        (tr, "Q15", "montants_sens_incoherents", "(sens = 'Débit' and montant >= 0) or (sens = 'Crédit' and montant <= 0)", 0),
        (tr, "Q15", "sens_inconnus", _outside("sens", ["Débit", "Crédit"]), 0),
        (tr, "Q16", "operations_avec_frais", "frais > 0", None),
        (tr, "Q16", "frais_negatifs_ou_absents", "frais is null or frais < 0", 0),
        (tr, "Q16", "frais_hors_operation_bancaire", "frais > 0 and type_transaction <> 'Frais bancaires'", 0),
        (tr, "Q16", "operations_frais_sans_frais", "type_transaction = 'Frais bancaires' and (frais is null or frais <= 0)", 0),
    ]


def _status(value: str, limit: int | None) -> str:
    return "'INFO'" if limit is None else f"case when {value} = {limit} then 'OK' else 'ATTENTION' end"


def _line(table: str, family: str, name: str, value: str, limit: int | None, source: str) -> str:
    return (
        f"select '{family}' as famille, '{table}' as nom_table, '{name}' as controle, cast(v as bigint) as valeur,"
        f" {_status('v', limit)} as statut from (select {value} as v from {source}) t"
    )


def _layer(table: str) -> str:
    layer, name = table.split(".")
    return {"raw": "raw_", "staging": "stg_"}[layer] + name


COUNTED = _raw_conditions() + _staging_conditions()


def counted_sql(families: tuple[str, ...]) -> str:
    return " union all ".join(
        _line(t, f, n, f"count(*) filter (where {cond})", limit, _layer(t))
        for t, f, n, cond, limit in COUNTED
        if f in families
    )


_TITLES = {
    "Q2": "failed_conversions", "Q4": "missing_values", "Q5": "formats", "Q6": "numeric_ranges",
    "Q7": "date_plausibility", "Q8": "closed_domains", "Q9": "residual_mojibake", "Q15": "sign_and_direction",
    "Q16": "fee_consistency",
}
for _family, _title in _TITLES.items():
    register(f"q{int(_family[1:]):02d}_{_title}", counted_sql((_family,)))(
        lambda x, family=_family: quality.counted(x.raw, x.staging, AS_OF, (family,))
    )


_Q1 = []
for _t in RAW_COLUMNS:
    _dedup = _t in quality.DEDUPLICATED
    _ok = "lignes_retirees >= 0" if _dedup else "lignes_retirees = 0"
    _good = (
        f"concat('{_t} : ', lignes_staging, ' lignes uniques, ', lignes_retirees, ' répétition(s) écartée(s).')"
        if _dedup else f"concat('{_t} : ', lignes_raw, ' lignes, aucune perdue.')"
    )
    _Q1.append(f"""select '{_t}' as nom_table, lignes_raw, lignes_staging, lignes_retirees,
 case when {_ok} then 'OK' else 'ATTENTION' end as statut,
 case when {_ok} then {_good} else concat('{_t} : ', abs(lignes_retirees), ' ligne(s) d’écart.') end as conclusion
 from (select a as lignes_raw, b as lignes_staging, a - b as lignes_retirees from (select (select count(*) from raw_{_t}) as a,
 (select count(*) from stg_{_t}) as b) u) t""")


@register("q01_row_counts", " union all ".join(_Q1))
def _(x: Context) -> DataFrame:
    return quality.row_counts(x.raw, x.staging)


def _dups(source: str, *keys: str) -> str:
    listed = ", ".join(keys)
    present = " and ".join(f"{k} is not null" for k in keys)
    return f"(select {listed}, count(*) as n from {source} where {present} group by {listed} having count(*) > 1)"


_DUP = [
    ("staging.agences", ("agence_id",)), ("raw.clients", (b2n("client_id"),)), ("raw.credits", (b2n("credit_id"),)),
    ("staging.objectifs_agences", ("agence_id", "mois")), ("staging.produits", ("produit_id",)),
    ("staging.remboursements", ("remboursement_id",)), ("raw.transactions", (b2n("transaction_id"),)),
    ("staging.transactions", ("transaction_id",)),
]


@register("q03_duplicates", " union all ".join(
    _line(t, "Q3", name, value, None if t.startswith("raw") else 0, f"{_dups(_layer(t), *keys)} d")
    for t, keys in _DUP
    for name, value in (("cles_dupliquees", "count(*)"), ("lignes_en_trop", "coalesce(sum(n - 1), 0)"))))
def _(x: Context) -> DataFrame:
    return quality.duplicate_report(x.raw, x.staging)


@register("q03_duplicate_list", f"""select {b2n('transaction_id')} as transaction_id, cast(count(*) as bigint) as nombre_occurrences
 from raw_transactions where {b2n('transaction_id')} is not null group by 1 having count(*) > 1""")
def _(x: Context) -> DataFrame:
    return quality.duplicate_list(x.raw, x.staging, "raw", "transactions")


# Staging lists are empty by construction, which q03_duplicates counts; these are the raw ones that hold repetitions.
for _t, _key in {"clients": "client_id"}.items():
    register(f"q03_duplicate_list_{_t}", f"""select {b2n(_key)} as {_key}, cast(count(*) as bigint) as nombre_occurrences
 from raw_{_t} where {b2n(_key)} is not null group by 1 having count(*) > 1""")(
        lambda x, t=_t: quality.duplicate_list(x.raw, x.staging, "raw", t)
    )


def _orphans(layer: str, table: str, column: str, ref: str, ref_column: str) -> str:
    key = f"upper({b2n(column)})"
    return (
        f"(select * from {_layer(f'{layer}.{table}')} where {key} is not null and {key} not in "
        f"{O._refs(ref, ref_column)}) o"
    )


# Every reference: layer, table, column, reference, its key, and the table's own identifier.
_ORPHANS = [
    ("staging", "clients", "agence_id", "agences", "agence_id", "client_id"),
    ("raw", "credits", "agence_id", "agences", "agence_id", "credit_id"),
    ("staging", "objectifs_agences", "agence_id", "agences", "agence_id", "mois"),
    ("raw", "remboursements", "credit_id", "credits", "credit_id", "remboursement_id"),
    ("raw", "transactions", "client_id", "clients", "client_id", "transaction_id"),
    ("raw", "transactions", "produit_id", "produits", "produit_id", "transaction_id"),
    ("raw", "transactions", "agence_id", "agences", "agence_id", "transaction_id"),
]
_FIRST_ORPHANS = ("raw", "credits", "client_id", "clients", "client_id", "credit_id")


@register("q10_orphan_references", " union all ".join(
    _line(f"{layer}.{t}", "Q10", f"{c}_orphelins", "count(*)", 0, _orphans(layer, t, c, ref, rc))
    for layer, t, c, ref, rc, _ in [_FIRST_ORPHANS, *_ORPHANS]) + " union all " + counted_sql(("Q10",)))
def _(x: Context) -> DataFrame:
    return quality.orphan_report(x.raw, x.staging).unionByName(
        quality.counted(x.raw, x.staging, AS_OF, ("Q10",))
    )


@register("q10_orphan_list", f"""select credit_id, client_id from {_orphans('raw', 'credits', 'client_id', 'clients', 'client_id')}""")
def _(x: Context) -> DataFrame:
    return quality.orphan_list(x.raw, x.staging, "raw", "credits", "client_id", "credit_id")


for _l, _t, _c, _r, _rc, _k in _ORPHANS:
    register(f"q10_orphan_list_{_t}_{_c}", f"select {_k}, {_c} from {_orphans(_l, _t, _c, _r, _rc)}")(
        lambda x, layer=_l, t=_t, c=_c, k=_k: quality.orphan_list(x.raw, x.staging, layer, t, c, k)
    )
for _l, _t, _c, _r, _rc, _k in [*_ORPHANS, _FIRST_ORPHANS]:
    if _l == "raw":
        register(f"q10_orphan_changes_{_t}_{_c}", f"""select s.{_k}, o.{_c} as {_c}_avant, s.{_c} as {_c}_apres
 from {_orphans(_l, _t, _c, _r, _rc)} join stg_{_t} s on upper({b2n(f'o.{_k}')}) = upper(s.{_k})""")(
            lambda x, t=_t, c=_c, k=_k: quality.orphan_changes(x.raw, x.staging, t, c, k)
        )


_NEG = {"clients": ("client_id", "revenu_mensuel", 12, 2), "credits": ("credit_id", "taux_annuel", 6, 3),
        "remboursements": ("remboursement_id", "montant_paye", 15, 2)}


def _neg(table: str) -> str:
    key, column, p, s = _NEG[table]
    value = O.sdec(f"r.{column}", p, s)
    return (f"(select s.{key}, {value} as valeur_source, s.{column} as valeur_staging from raw_{table} r join stg_{table} s"
            f" on upper({b2n(f'r.{key}')}) = upper(s.{key}) where ({value}) < 0) n")


@register("q11_negatives_nullified", counted_sql(("Q11",)) + " union all " + " union all ".join(
    _line(f"raw-staging.{t}", "Q11", name, value, None, _neg(t)) for t in _NEG
    for name, value in (("negatifs_rapproches", "count(*)"),
                        ("remplaces_par_null", "count(*) filter (where valeur_staging is null)"))))
def _(x: Context) -> DataFrame:
    return quality.counted(x.raw, x.staging, AS_OF, ("Q11",)).unionByName(
        quality.negative_report(x.raw, x.staging)
    )


@register("q11_negative_rows", f"select * from {_neg('remboursements')}")
def _(x: Context) -> DataFrame:
    return quality.negatives(x.raw, x.staging, "remboursements")


for _t in ("clients", "credits"):
    register(f"q11_negative_rows_{_t}", f"select * from {_neg(_t)}")(lambda x, t=_t: quality.negatives(x.raw, x.staging, t))


# Compared texts: key, columns, first source line only, accents repaired first, missing values ignored.
_CHANGED = {
    "agences": ("agence_id", ["nom_agence", "ville", "departement", "region", "categorie_agence"], False, False, False),
    "clients": ("client_id", ["prenom", "profession", "segment", "ville", "email"], True, False, False),
    "credits": ("credit_id", ["type_credit", "statut_credit"], False, True, False),
    "produits": ("produit_id", ["nom_produit", "famille_produit", "univers"], False, True, False),
    "remboursements": ("remboursement_id", ["statut_remboursement"], False, True, True),
    "transactions": ("transaction_id", ["type_transaction", "sens", "canal", "statut", "devise"], True, True, True),
}


def _pairs(table: str) -> str:
    key, columns, first_line, _, _ = _CHANGED[table]
    rkey = f"upper({b2n(key)})"
    source = f"(select *, {rkey} as k from raw_{table})"
    if first_line:
        source = (f"(select * from (select *, {rkey} as k, row_number() over (partition by {rkey} order by {O.sint('ligne_source')}"
                  f" nulls first) as rang from raw_{table}) q where rang = 1)")
    listed = ", ".join(f"r.{c} as {c}_avant, s.{c} as {c}_apres" for c in columns)
    return f"(select s.{key}, {listed} from {source} r join stg_{table} s on r.k = upper(s.{key})) p"


def _change(table: str, column: str) -> str:
    _, _, _, cleaned, exact = _CHANGED[table]
    before = O.clean(f"{column}_avant") if cleaned else b2n(f"{column}_avant")
    before = f"upper({before})" if column == "devise" else before
    if exact:
        return f"({before} <> {column}_apres)"
    return f"(coalesce({before}, '') <> coalesce({column}_apres, ''))"


def _any_change(table: str) -> str:
    return " or ".join(f"coalesce({_change(table, c)}, false)" for c in _CHANGED[table][1])


@register("q12_texts_changed", counted_sql(("Q12",)) + " union all " + " union all ".join(
    _line(f"raw-staging.{t}", "Q12", name, f"count(*) filter (where {cond})", None, _pairs(t))
    for t, spec in _CHANGED.items()
    for name, cond in [("lignes_modifiees", _any_change(t)), *[(f"{c}_modifies", _change(t, c)) for c in spec[1]]]))
def _(x: Context) -> DataFrame:
    return quality.counted(x.raw, x.staging, AS_OF, ("Q12",)).unionByName(
        quality.change_report(x.raw, x.staging)
    )


for _t in _CHANGED:
    register(f"q12_changed_rows_{_t}", f"select * from {_pairs(_t)} where {_any_change(_t)}")(
        lambda x, t=_t: quality.changes(x.raw, x.staging, t)
    )


@register("q07_impossible_dates", f"""select s.transaction_id, r.date_transaction as date_source, s.date_transaction as date_apres
 from raw_transactions r join stg_transactions s on upper({b2n('r.transaction_id')}) = s.transaction_id
 where {b2n('r.date_transaction')} is not null and ({O.sts('r.date_transaction')}) is null""")
def _(x: Context) -> DataFrame:
    return quality.impossible_dates(x.raw, x.staging)


@register("q13_month_continuity", """select min(mois) as premier_mois, max(mois) as dernier_mois,
 cast(count(distinct mois) as bigint) as mois_distincts,
 cast((year(max(mois)) - year(min(mois))) * 12 + month(max(mois)) - month(min(mois)) + 1 as bigint) as mois_attendus,
 cast(count(*) filter (where day(mois) <> 1) as bigint) as dates_hors_premier_jour,
 case when count(distinct mois) = (year(max(mois)) - year(min(mois))) * 12 + month(max(mois)) - month(min(mois)) + 1
  and count(*) filter (where day(mois) <> 1) = 0 then 'OK' else 'ATTENTION' end as statut from stg_objectifs_agences""")
def _(x: Context) -> DataFrame:
    return quality.month_continuity(x.staging)


_GAP = """(select count(*) from (select {m} from stg_objectifs_agences where agence_id is not null and mois is not null group by 1
 having count(distinct {a}) <> (select count(distinct {a}) from stg_objectifs_agences)) g)"""


@register("q14_grid", f"""select *, case when lignes_reelles = lignes_theoriques and agences_periode_incomplete = 0
 and mois_agences_incompletes = 0 then 'OK' else 'ATTENTION' end as statut from (
 select cast(count(distinct agence_id) as bigint) as agences_distinctes, cast(count(distinct mois) as bigint) as mois_distincts,
 cast(count(*) as bigint) as lignes_reelles, cast(count(distinct agence_id) * count(distinct mois) as bigint) as lignes_theoriques,
 cast({_GAP.format(m='agence_id', a='mois')} as bigint) as agences_periode_incomplete,
 cast({_GAP.format(m='mois', a='agence_id')} as bigint) as mois_agences_incompletes from stg_objectifs_agences) t""")
def _(x: Context) -> DataFrame:
    return quality.grid(x.staging)


@register("q14_month_gaps", """select mois, cast(count(distinct agence_id) as bigint) as nombre_agences_disponibles,
 (select cast(count(distinct agence_id) as bigint) from stg_objectifs_agences) as nombre_agences_attendues from stg_objectifs_agences
 where agence_id is not null and mois is not null group by 1
 having count(distinct agence_id) <> (select count(distinct agence_id) from stg_objectifs_agences)""")
def _(x: Context) -> DataFrame:
    return quality.month_gaps(x.staging)


@register("q17_payment_split", """select *, case when paiements_complets + paiements_partiels + echeances_impayees + montants_invalides_null
 = total_echeances then 'OK' else 'ATTENTION' end as statut from (select
 count(*) filter (where montant_paye = montant_attendu) as paiements_complets,
 count(*) filter (where montant_paye > 0 and montant_paye < montant_attendu) as paiements_partiels,
 count(*) filter (where montant_paye = 0) as echeances_impayees, count(*) filter (where montant_paye is null) as montants_invalides_null,
 count(*) as total_echeances from stg_remboursements) t""")
def _(x: Context) -> DataFrame:
    return quality.payment_split(x.staging)


@register("q18_target_ranges", "select " + ", ".join(
    f"{f}({v}) as {v}_{n}" for v in RAW_COLUMNS["objectifs_agences"][2:] for f, n in (("min", "minimum"), ("max", "maximum")))
    + " from stg_objectifs_agences")
def _(x: Context) -> DataFrame:
    return quality.target_ranges(x.staging)


@register("q18_repayment_ranges", """select *, concat('Échéances du ', strftime(premiere_echeance, '%d/%m/%Y'), ' au ',
 strftime(derniere_echeance, '%d/%m/%Y'), ', retards de ', retard_minimum, ' à ', retard_maximum, ' jours.') as conclusion
 from (select min(date_echeance) as premiere_echeance, max(date_echeance) as derniere_echeance, min(date_paiement) as premier_paiement,
 max(date_paiement) as dernier_paiement, min(jours_retard) as retard_minimum, max(jours_retard) as retard_maximum from stg_remboursements) t""")
def _(x: Context) -> DataFrame:
    return quality.repayment_ranges(x.staging)


@register("q06_extremes", " union all ".join(
    f"select '{t}' as nom_table, '{c}' as colonne, cast(min({c}) as varchar) as minimum, cast(max({c}) as varchar) as maximum from stg_{t}"
    for t, c in (("agences", "effectif"), ("agences", "date_ouverture"), ("produits", "niveau_complexite"), ("transactions", "date_transaction"))))
def _(x: Context) -> DataFrame:
    return quality.extremes(x.staging)


_LABELS = (("agences", "categorie_agence"), ("credits", "type_credit"), ("credits", "statut_credit"), ("produits", "niveau_complexite"),
           ("produits", "famille_produit"), ("produits", "univers"), ("remboursements", "statut_remboursement"), ("transactions", "statut"))


@register("q19_label_distributions", " union all ".join(
    f"select '{t}' as nom_table, '{c}' as colonne, cast({c} as varchar) as valeur, cast(count(*) as bigint) as nombre from stg_{t} group by 3"
    for t, c in _LABELS))
def _(x: Context) -> DataFrame:
    return quality.label_distributions(x.staging)


@register("q19_amounts_by_direction", """select sens, cast(count(*) as bigint) as nombre_transactions,
 cast(sum(montant) as decimal(38,2)) as montant_total from stg_transactions group by 1""")
def _(x: Context) -> DataFrame:
    return quality.distribution(x.staging["transactions"], "sens", count="nombre_transactions", montant_total="montant")


_SUMMARY = {
    "credits": {"total_credits": "count(*)"},
    "objectifs_agences": {"total_objectifs": "count(*)", "total_agences": "count(distinct agence_id)", "total_mois": "count(distinct mois)"},
    "produits": {"total_produits": "count(*)", "total_familles": "count(distinct famille_produit)", "total_univers": "count(distinct univers)"},
    "remboursements": {"total_echeances": "count(*)", "total_impayes": "count(*) filter (where statut_remboursement = 'Impayé')",
                       "total_paiements_en_retard": "count(*) filter (where statut_remboursement = 'Payé en retard')"},
    "transactions": {"total_transactions": "count(*)", "clients_distincts": "count(distinct client_id)",
                     "dates_impossibles_null": "count(*) filter (where date_transaction is null)",
                     "produits_absents_null": "count(*) filter (where produit_id is null)",
                     "agences_orphelines_null": "count(*) filter (where agence_id is null)"},
}


@register("q20_final_summaries", " union all ".join(
    _line(f"staging.{t}", "Q20", n, v, None, f"stg_{t}") for t, figures in _SUMMARY.items() for n, v in figures.items()))
def _(x: Context) -> DataFrame:
    return quality.final_summaries(x.staging)


@register("q21_preview", "select * from stg_transactions order by transaction_id limit 20")
def _(x: Context) -> DataFrame:
    return quality.preview(x.staging, "transactions")


_FIRST = {"agences": "agence_id", "clients": "client_id", "credits": "credit_id", "objectifs_agences": "agence_id, mois",
          "produits": "produit_id", "remboursements": "remboursement_id"}
for _t, _order in _FIRST.items():
    _by = ", ".join(f"{c} nulls first" for c in _order.split(", "))
    register(f"q21_preview_{_t}", f"select * from stg_{_t} order by {_by} limit 20")(lambda x, t=_t: quality.preview(x.staging, t))

for _t, _key in {"agences": "agence_id", "clients": "client_id", "credits": "credit_id", "objectifs_agences": "agence_id",
                 "produits": "produit_id", "remboursements": "remboursement_id"}.items():
    _columns = [_key, *[c for c in RAW_COLUMNS[_t] if c in STAGING_TYPES[_t] and c != _key]]
    register(f"q02_failed_conversion_rows_{_t}", f"""select {', '.join(_columns)} from raw_{_t}
 where {' or '.join(_failed(_t, c) for c in STAGING_TYPES[_t])}""")(
        lambda x, t=_t, key=_key: quality.conversion_offenders(x.raw, t, [key])
    )

# Raw rows behind the counted checks of missing values and formats. The testbed damages no credit and no repayment
# code that way: those two lists would be empty and are tested on rows of their own.
_UNDAMAGED = {("raw.credits", "lignes_source_incompletes"), ("raw.remboursements", "remboursement_id_invalides")}
for _source, _family, _name, _where, _ in _raw_conditions():
    if _family in ("Q4", "Q5") and (_source, _name) not in _UNDAMAGED:
        _t = _source.removeprefix("raw.")
        register(f"q0{_family[1:]}_raw_rows_{_t}_{_name}", f"select * from raw_{_t} where {_where}")(
            lambda x, t=_t, name=_name: quality.raw_offenders(x.raw, t, name, [])
        )


@register("q02_failed_conversion_rows", f"""select transaction_id, ligne_source, date_transaction, montant, frais from raw_transactions
 where {' or '.join(_failed('transactions', c) for c in ('ligne_source', 'date_transaction', 'montant', 'frais'))}""")
def _(x: Context) -> DataFrame:
    return quality.conversion_offenders(x.raw, "transactions", ["transaction_id", "ligne_source"])


@register("q15_offending_rows", """select * from stg_transactions where (sens = 'Débit' and montant >= 0) or (sens = 'Crédit' and montant <= 0)""")
def _(x: Context) -> DataFrame:
    return quality.offenders(x.staging, "transactions", "montants_sens_incoherents", AS_OF, ["transaction_id"])


@register("q07_offending_credits", """select credit_id, date_octroi, duree_mois, date_fin_prevue from stg_credits
 where date_octroi is null or date_fin_prevue is null or date_fin_prevue <= date_octroi
 or cast(date_octroi + to_months(duree_mois) as date) <> date_fin_prevue""")
def _(x: Context) -> DataFrame:
    return quality.offenders(x.staging, "credits", "dates_incoherentes", AS_OF, ["credit_id"]).select(
        "credit_id", "date_octroi", "duree_mois", "date_fin_prevue"
    )


# ================================================================ M: model controls
def _count(table: str, where: str = "") -> str:
    return f"(select count(*) from {table}{' where ' + where if where else ''})"


def _sum(column: str, table: str) -> str:
    return f"(select coalesce(sum({column}), 0) from {table})"


def _missing(table: str, column: str, dim: str) -> str:
    key = controls.DIMENSION_KEYS[dim]
    business = "date_complete" if dim == "dim_date" else f"{dim[4:]}_id"
    value = f"cast(t.{column} as date)" if dim == "dim_date" else f"t.{column}"
    return (
        f"(select count(*) from stg_{table} t left join {dim} d on d.{business} = {value} and d.{key} <> 0"
        f" where d.{key} is null)"
    )


def _via_credit(dim: str) -> str:
    key, business = controls.DIMENSION_KEYS[dim], f"{dim[4:]}_id"
    return (f"(select count(*) from stg_remboursements r left join stg_credits cr on cr.credit_id = r.credit_id"
            f" left join {dim} d on d.{business} = cr.{business} and d.{key} <> 0 where d.{key} is null)")


def _zero(fact: str, column: str) -> str:
    return _count(fact, f"{column} = 0")


def _broken(fact: str) -> str:
    tests = " or ".join(
        f"{fk} not in (select {controls.DIMENSION_KEYS[d]} from {d})" for f, fk, d in controls.RELATIONSHIPS if f == fact
    )
    return _count(fact, tests)


_SPAN = "(select date_diff('day', date_min, date_max) + 1 from date_bounds)"
_T, _C, _R, _O, _E = controls.FACTS
_REAL = {d: _count(d, f"{k} <> 0") for d, k in controls.DIMENSION_KEYS.items()}
_SIDES: list[tuple[str, str]] = [
    ("16", "16"),
    (_SPAN, _REAL["dim_date"]),
    (_count("stg_agences"), _REAL["dim_agence"]),
    (_count("stg_clients"), _REAL["dim_client"]),
    (_count("stg_produits"), _REAL["dim_produit"]),
    *[("1", _count(d, f"{k} = 0")) for d, k in controls.DIMENSION_KEYS.items()],
    *[(_REAL[d], f"(select count(distinct {d[4:]}_id) from {d} where {d[4:]}_key <> 0)") for d in ("dim_agence", "dim_client", "dim_produit")],
    (_count("stg_transactions"), _count(_T)),
    (_count("stg_credits"), _count(_C)),
    (_count("stg_remboursements"), _count(_R)),
    (_count("stg_objectifs_agences"), _count(_O)),
    (_count("stg_clients"), _count(_E)),
    (_count(_T), f"(select count(distinct transaction_id) from {_T})"),
    (_count(_C), f"(select count(distinct credit_id) from {_C})"),
    (_count(_R), f"(select count(distinct remboursement_id) from {_R})"),
    ("0", f"(select count(*) from (select 1 from {_O} group by date_key, agence_key having count(*) > 1) g)"),
    ("0", f"(select count(*) from (select 1 from {_E} group by client_key having count(*) > 1) g)"),
    (_missing("transactions", "date_transaction", "dim_date"), _zero(_T, "date_key")),
    (_missing("transactions", "client_id", "dim_client"), _zero(_T, "client_key")),
    (_missing("transactions", "agence_id", "dim_agence"), _zero(_T, "agence_key")),
    (_missing("transactions", "produit_id", "dim_produit"), _zero(_T, "produit_key")),
    (_missing("credits", "date_octroi", "dim_date"), _zero(_C, "date_octroi_key")),
    (_missing("credits", "date_fin_prevue", "dim_date"), _zero(_C, "date_fin_prevue_key")),
    (_missing("credits", "client_id", "dim_client"), _zero(_C, "client_key")),
    (_missing("credits", "agence_id", "dim_agence"), _zero(_C, "agence_key")),
    (_missing("remboursements", "date_echeance", "dim_date"), _zero(_R, "date_echeance_key")),
    (_missing("remboursements", "date_paiement", "dim_date"), _zero(_R, "date_paiement_key")),
    (_via_credit("dim_client"), _zero(_R, "client_key")),
    (_via_credit("dim_agence"), _zero(_R, "agence_key")),
    (_missing("objectifs_agences", "mois", "dim_date"), _zero(_O, "date_key")),
    (_missing("objectifs_agences", "agence_id", "dim_agence"), _zero(_O, "agence_key")),
    (_missing("clients", "date_entree", "dim_date"), _zero(_E, "date_key")),
    (_missing("clients", "client_id", "dim_client"), _zero(_E, "client_key")),
    (_missing("clients", "agence_id", "dim_agence"), _zero(_E, "agence_key")),
    (_sum("montant", "stg_transactions"), _sum("montant_signe", _T)),
    (_sum("montant_initial", "stg_credits"), _sum("montant_initial", _C)),
    (_sum("montant_attendu", "stg_remboursements"), _sum("montant_attendu", _R)),
    (_sum("montant_paye", "stg_remboursements"), _sum("montant_paye", _R)),
    (_sum("objectif_revenu", "stg_objectifs_agences"), _sum("objectif_revenu", _O)),
    (_sum("objectif_production_credit", "stg_objectifs_agences"), _sum("objectif_production_credit", _O)),
    ("0", _count(_T, "nombre_transactions <> 1")),
    ("0", _count(_T, "(sens = 'Débit' and montant_debit <> abs(coalesce(montant_signe, 0))) or (coalesce(sens, '') <> 'Débit' and montant_debit <> 0)")),
    ("0", _count(_T, "(sens = 'Crédit' and montant_credit <> coalesce(montant_signe, 0)) or (coalesce(sens, '') <> 'Crédit' and montant_credit <> 0)")),
    ("0", _count(_C, "nombre_credits <> 1")),
    ("0", _count(_R, "nombre_echeances <> 1")),
    ("0", _count(_R, "est_impaye <> case when statut_remboursement = 'Impayé' then true else false end")),
    ("0", _count(_R, "est_en_retard <> case when statut_remboursement = 'Payé en retard' then true else false end")),
    ("0", _count(_R, "(montant_paye is null and montant_non_paye is not null) or (montant_paye is not null and montant_non_paye <> "
                     "case when montant_attendu - montant_paye < 0 then 0 else montant_attendu - montant_paye end)")),
    ("0", _count(_O, "nombre_lignes_objectif <> 1")),
    ("0", _count(_E, "nombre_nouveaux_clients <> 1")),
    *[("0", _broken(f)) for f in controls.FACTS],
    ("17", "(select count(*) from (" + " union all ".join(
        f"select {_count(f, f'{fk} not in (select {controls.DIMENSION_KEYS[d]} from {d})')} as n" for f, fk, d in controls.RELATIONSHIPS)
     + ") g where n = 0)"),
]
assert len(_SIDES) == len(controls.CONTROLS) == 61


def _comment(text: str) -> str:
    out = f"'{text}'"
    for name, value in {
        "premiere_date": "(select strftime(date_min, '%d/%m/%Y') from date_bounds)",
        "derniere_date": "(select strftime(date_max, '%d/%m/%Y') from date_bounds)",
        "credits_introuvables": "cast((select count(*) from stg_remboursements r left join stg_credits c on c.credit_id = r.credit_id"
                                " where c.credit_id is null) as varchar)",
        "agences_credit_inconnues": "cast((select count(*) from stg_remboursements r join stg_credits c on c.credit_id = r.credit_id"
                                    " left join dim_agence a on a.agence_id = c.agence_id and a.agence_key <> 0"
                                    " where a.agence_key is null) as varchar)",
    }.items():
        if "{" + name + "}" in text:
            out = f"replace({out}, '{{{name}}}', {value})"
    return out


def controls_sql(category: str | None = None) -> str:
    return " union all ".join(
        f"""select cast({i} as integer) as controle_id, '{c.category}' as categorie, '{c.name}' as controle, a as valeur_attendue,
 b as valeur_observee, cast(b - a as decimal(38,4)) as ecart, case when a = b then 'OK' else 'ATTENTION' end as statut,
 {_comment(c.comment)} as commentaire
 from (select cast({a} as decimal(38,4)) as a, cast({b} as decimal(38,4)) as b) t"""
        for i, (c, (a, b)) in enumerate(zip(controls.CONTROLS, _SIDES, strict=True), 1)
        if category in (None, c.category)
    )


@register("m00_all_controls", controls_sql())
def _(x: Context) -> DataFrame:
    return controls.controls(x.staging, x.mart)


def _figures(names: list[str], sides: list[str]) -> str:
    return " union all ".join(
        f"select '{n}' as mesure, cast({s} as decimal(38,4)) as valeur" for n, s in zip(names, sides, strict=True)
    )


def _long(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [unpivot(f, controls.VALUE) for f in frames])


_DIM_FIGURES = (
    [(f"{d}_reels", _REAL[d]) for d in controls.DIMENSION_KEYS]
    + [(f"{d}_inconnus", _count(d, f"{k} = 0")) for d, k in controls.DIMENSION_KEYS.items()]
    + [(f"{d}_distincts", f"(select count(distinct {d[4:]}_id) from {d} where {d[4:]}_key <> 0)") for d in ("dim_agence", "dim_client", "dim_produit")]
    + [("jours_attendus", _SPAN), ("jours_observes", _REAL["dim_date"])]
)


@register("m02_m05_dimension_figures", _figures(*map(list, zip(*_DIM_FIGURES))))
def _(x: Context) -> DataFrame:
    return _long(controls.dimension_figures(x.staging, x.dims))


_UNKNOWN = [
    (f"attendu:{f}.{fk}", side)
    for (f, fk), side in zip(
        [(_T, "date_key"), (_T, "client_key"), (_T, "agence_key"), (_T, "produit_key"), (_C, "date_octroi_key"),
         (_C, "date_fin_prevue_key"), (_C, "client_key"), (_C, "agence_key"), (_R, "date_echeance_key"), (_R, "date_paiement_key"),
         (_R, "client_key"), (_R, "agence_key"), (_O, "date_key"), (_O, "agence_key"), (_E, "date_key"), (_E, "client_key"), (_E, "agence_key")],
        [a for a, _ in _SIDES[22:39]], strict=True)
]


_CAUSES = [
    ("credits_introuvables", "(select count(*) from stg_remboursements r left join stg_credits c on c.credit_id = r.credit_id"
                             " where c.credit_id is null)"),
    ("agences_credit_inconnues", "(select count(*) from stg_remboursements r join stg_credits c on c.credit_id = r.credit_id"
                                 " left join dim_agence a on a.agence_id = c.agence_id and a.agence_key <> 0 where a.agence_key is null)"),
]


@register("m08_m11_unknown_keys", _figures(*map(list, zip(*[*_UNKNOWN, *_CAUSES]))))
def _(x: Context) -> DataFrame:
    return controls.unknown_key_figures(x.staging, x.dims)


# Every figure of a fact: rows, unknown keys, sums and indicators, by the position of its control.
_FACT_FIGURES = (
    [(f"{f}_lignes", _count(f)) for f in controls.FACTS]
    + [(f"observe:{f}.{fk}", _zero(f, fk)) for f, fk, _ in controls.RELATIONSHIPS]
    + list(zip(
        ("fact_montant_signe", "fact_montant_initial", "fact_montant_attendu", "fact_montant_paye", "fact_objectif_revenu",
         "fact_objectif_production_credit", "nombre_transactions_invalides", "montant_debit_invalides", "montant_credit_invalides",
         "nombre_credits_invalides", "nombre_echeances_invalides", "est_impaye_incoherents", "est_en_retard_incoherents",
         "montant_non_paye_incoherents", "nombre_lignes_objectif_invalides", "nombre_nouveaux_clients_invalides"),
        [b for _, b in _SIDES[39:55]], strict=True))
)


@register("m06_m13_fact_figures", _figures(*map(list, zip(*_FACT_FIGURES))))
def _(x: Context) -> DataFrame:
    return _long(controls.fact_figures(x.facts))


@register("m07_grain_figures", _figures(
    ["transaction_id_distincts", "credit_id_distincts", "remboursement_id_distincts", "objectifs_doublons", "entrees_doublons"],
    [b for _, b in _SIDES[17:22]]))
def _(x: Context) -> DataFrame:
    return _long(controls.grain_figures(x.facts))


@register("m14_any_broken_key", _figures([f"orphelins:{f}" for f in controls.FACTS] + ["relations_verifiees"], [b for _, b in _SIDES[55:61]]))
def _(x: Context) -> DataFrame:
    return _long(controls.integrity_figures(x.dims, x.facts))


@register("m15_relationships", " union all ".join(
    f"""select '{f}' as table_faits, '{fk}' as cle, '{d}' as dimension, n as orphelins, case when n = 0 then 'OK' else 'ATTENTION' end as statut
 from (select cast({_count(f, f'{fk} not in (select {controls.DIMENSION_KEYS[d]} from {d})')} as bigint) as n) t"""
    for f, fk, d in controls.RELATIONSHIPS))
def _(x: Context) -> DataFrame:
    return controls.relationship_report(x.dims, x.facts)


_VOLUMES = {
    "dates_reelles": _REAL["dim_date"], "agences_reelles": _REAL["dim_agence"], "clients_reels": _REAL["dim_client"],
    "produits_reels": _REAL["dim_produit"], "transactions": _count(_T), "credits": _count(_C), "remboursements": _count(_R),
    "objectifs_agences": _count(_O), "entrees_clients": _count(_E),
}


@register("m18_verdict", f"""select *, case when controles_attention = 0 then concat('Modèle validé : ', controles_realises,
 ' contrôles conformes (', dates_reelles, ' jours, ', agences_reelles, ' agences, ', clients_reels, ' clients, ', produits_reels,
 ' produits ; ', transactions, ' transactions, ', credits, ' crédits, ', remboursements, ' échéances, ', objectifs_agences,
 ' objectifs, ', entrees_clients, ' entrées).')
 else concat('Modèle à vérifier : ', controles_attention, ' contrôle(s) en écart sur ', controles_realises, '.') end as conclusion_finale from (select count(*) as controles_realises,
 count(*) filter (where statut = 'OK') as controles_ok, count(*) filter (where statut = 'ATTENTION') as controles_attention,
 {', '.join(f'{v} as {n}' for n, v in _VOLUMES.items())} from ({controls_sql()}) c) t""")
def _(x: Context) -> DataFrame:
    return controls.verdict(controls.controls(x.staging, x.mart), x.mart)


# ============================================================ Y: business summaries
def _amount(column: str, name: str) -> str:
    return f"cast(coalesce(sum({column}), 0) as decimal(38,2)) as {name}"


@register("y1_transactions", f"""select cast(sum(nombre_transactions) as bigint) as nombre_transactions, {_amount('montant_debit', 'montant_total_debits')},
 {_amount('montant_credit', 'montant_total_credits')}, {_amount('frais', 'total_frais')} from fact_transactions""")
def _(x: Context) -> DataFrame:
    return summaries.transactions(x.mart)


@register("y2_credits", f"""select cast(sum(nombre_credits) as bigint) as nombre_credits, {_amount('montant_initial', 'production_totale_credit')},
 cast(round(avg(taux_annuel), 3) as decimal(10,3)) as taux_annuel_moyen, count(*) filter (where taux_annuel is null) as taux_annuels_invalides
 from fact_credits""")
def _(x: Context) -> DataFrame:
    return summaries.credits(x.mart)


@register("y3_repayments", f"""select cast(sum(nombre_echeances) as bigint) as nombre_echeances, cast(sum(cast(est_impaye as int)) as bigint) as nombre_impayes,
 cast(sum(cast(est_en_retard as int)) as bigint) as nombre_paiements_en_retard, {_amount('montant_attendu', 'montant_total_attendu')},
 {_amount('montant_paye', 'montant_total_paye')}, {_amount('montant_non_paye', 'montant_total_non_paye')} from fact_remboursements""")
def _(x: Context) -> DataFrame:
    return summaries.repayments(x.mart)


@register("y4_targets", f"""select cast(sum(nombre_lignes_objectif) as bigint) as nombre_lignes_objectif, count(distinct agence_key) as agences_concernees,
 count(distinct date_key) as mois_distincts, {_amount('objectif_revenu', 'objectif_revenu_total')},
 cast(coalesce(sum(objectif_nouveaux_clients), 0) as bigint) as objectif_nouveaux_clients_total,
 {_amount('objectif_production_credit', 'objectif_production_credit_total')} from fact_objectifs_agences""")
def _(x: Context) -> DataFrame:
    return summaries.targets(x.mart)


@register("y5_client_entries", """select cast(sum(nombre_nouveaux_clients) as bigint) as nombre_total_entrees_clients,
 count(distinct client_key) as clients_distincts, count(distinct agence_key) as agences_concernees,
 count(distinct date_key) as dates_entree_distinctes from fact_entrees_clients""")
def _(x: Context) -> DataFrame:
    return summaries.client_entries(x.mart)


@register("y6_unknown_branch_causes", """select case when cr.credit_id is null then 'Crédit introuvable' else 'Agence du crédit inconnue' end
 as cause_agence_inconnue, count(*) as nombre_echeances from stg_remboursements r left join stg_credits cr on cr.credit_id = r.credit_id
 left join dim_agence a on a.agence_id = cr.agence_id and a.agence_key <> 0 where cr.credit_id is null or a.agence_key is null group by 1""")
def _(x: Context) -> DataFrame:
    return summaries.unknown_branch_causes(x.staging, x.dims)


# ==================================================================== X: measures
def _dec(expr: str) -> str:
    return f"cast(coalesce({expr}, 0) as decimal(38,2))"


def _big(expr: str) -> str:
    return f"cast(coalesce({expr}, 0) as bigint)"


def _dbl(expr: str) -> str:
    """Exact decimal text to double, as the other engine converts it."""
    return f"cast(cast({expr} as varchar) as double)"


def _ratio(a: str, b: str) -> str:
    return f"{_dbl(a)} / nullif({_dbl(b)}, 0)"


FORMULAS = {
    "nb_transactions": _big("sum(nombre_transactions)"),
    "montant_debits": _dec("sum(montant_debit)"),
    "montant_credits": _dec("sum(montant_credit)"),
    "flux_net": "cast(coalesce(sum(montant_credit), 0) - coalesce(sum(montant_debit), 0) as decimal(38,2))",
    "frais_totaux": _dec("sum(frais)"),
    "montant_moyen": _ratio("sum(abs(montant_signe))", "count(montant_signe)"),
    "nb_rejetees": _big("count(*) filter (where statut = 'Rejetée')"),
    "taux_rejet": _ratio("count(*) filter (where statut = 'Rejetée')", "count(*)"),
    "nb_credits": _big("sum(nombre_credits)"),
    "production_credit": _dec("sum(montant_initial)"),
    "montant_moyen_credit": _ratio("sum(montant_initial)", "count(montant_initial)"),
    "taux_annuel_moyen": _ratio("sum(taux_annuel)", "count(taux_annuel)"),
    "mensualite_moyenne": _ratio("sum(mensualite_theorique)", "count(mensualite_theorique)"),
    "score_risque_moyen": _ratio("sum(score_risque_octroi)", "count(score_risque_octroi)"),
    "nb_echeances": _big("count(*)"),
    "nb_impayes": _big("count(*) filter (where est_impaye)"),
    "taux_impaye": _ratio("count(*) filter (where est_impaye)", "count(*)"),
    "nb_retards": _big("count(*) filter (where est_en_retard)"),
    "taux_retard": _ratio("count(*) filter (where est_en_retard)", "count(*)"),
    "montant_attendu": _dec("sum(f.montant_attendu)"),
    "montant_paye": _dec("sum(f.montant_paye)"),
    "montant_non_paye": _dec("sum(f.montant_non_paye)"),
    "taux_recouvrement": _ratio("sum(f.montant_paye)", "sum(f.montant_attendu)"),
    "jours_retard_moyens": _ratio("sum(jours_retard)", "count(jours_retard)"),
    "nouveaux_clients": _big("sum(nombre_nouveaux_clients)"),
    "objectif_revenu": _dec("sum(f.objectif_revenu)"),
    "objectif_nouveaux_clients": _big("sum(f.objectif_nouveaux_clients)"),
    "objectif_production_credit": _dec("sum(f.objectif_production_credit)"),
    "seuil_impaye_pct_moyen": _ratio("sum(seuil_taux_impaye_pct)", "count(seuil_taux_impaye_pct)"),
}
_ATTR = {
    "agence_libelle": "concat_ws(' - ', a.agence_id, a.nom_agence)",
    "produit_libelle": "concat_ws(' - ', p.produit_id, p.nom_produit)",
    "tranche_revenu": BAND.replace("revenu_mensuel", "c.revenu_mensuel"),
    "niveau_risque": LEVEL.replace("score_risque_initial", "c.score_risque_initial"),
    "agence_id": "a.agence_id",
    "produit_id": "p.produit_id",
}
_DATE_KEYS = {_T: "date_key", _C: "date_octroi_key", _R: "date_echeance_key", _O: "date_key", _E: "date_key"}


def star_sql(fact: str, names: list[str], by: list[str], where: str = "true", date_key: str | None = None) -> str:
    joins = f" join dim_date d on d.date_key = f.{date_key or _DATE_KEYS[fact]} join dim_agence a on a.agence_key = f.agence_key"
    if fact != _O:
        joins += " join dim_client c on c.client_key = f.client_key"
    if fact == _T:
        joins += " join dim_produit p on p.produit_key = f.produit_key"
    cols = [f"{_ATTR.get(b, b)} as {b}" for b in by] + [f"{FORMULAS[n]} as {n}" for n in names]
    group = f" group by {', '.join(str(i + 1) for i in range(len(by)))}" if by else ""
    return f"select {', '.join(cols)} from {fact} f{joins} where {where}{group}"


def _measured(name: str, model: M.Model, by: list[str], names: list[str] | None = None, filters=None, where: str = "true",
              role: str | None = None) -> None:
    chosen = names or {
        _T: ["nb_transactions", "montant_debits", "montant_credits", "flux_net", "frais_totaux", "montant_moyen", "nb_rejetees", "taux_rejet"],
        _C: ["nb_credits", "production_credit", "montant_moyen_credit", "taux_annuel_moyen", "mensualite_moyenne", "score_risque_moyen"],
        _R: ["nb_echeances", "nb_impayes", "taux_impaye", "nb_retards", "taux_retard", "montant_attendu", "montant_paye",
             "montant_non_paye", "taux_recouvrement", "jours_retard_moyens"],
    }[model.fact]
    date_key = model.date_fk(role)
    register(name, star_sql(model.fact, chosen, by, where, date_key))(
        lambda x: M.measure(x.mart, model, chosen, by, filters, role)
    )


_measured("x1_transaction_measures", M.TRANSACTIONS, ["annee_mois"])
_measured("x1_total", M.TRANSACTIONS, [])
_measured("x1_by_region_and_segment", M.TRANSACTIONS, ["region", "segment", "famille_produit"])
_measured("x2_credit_measures", M.CREDITS, ["annee", "type_credit"])
_measured("x2_production_by_planned_end", M.CREDITS, ["annee_mois"], ["nb_credits", "production_credit"], role="fin_prevue")
_measured("x3_repayment_measures", M.REPAYMENTS, ["annee_mois"])
_measured("x3_paid_by_payment_date", M.REPAYMENTS, ["annee_mois"], ["montant_paye"], role="paiement")
_measured("x3_by_branch", M.REPAYMENTS, ["agence_id"])


def profile_sql(by: str) -> str:
    return f"""select {_ATTR.get(by, by)} as {by}, count(distinct client_key) as nb_clients_distincts,
 {_ratio('sum(revenu_mensuel)', 'count(revenu_mensuel)')} as revenu_mensuel_moyen,
 {_ratio('sum(score_risque_initial)', 'count(score_risque_initial)')} as score_risque_moyen from dim_client c where client_key <> 0 group by 1"""


def performance_sql(by: list[str], wheres: dict[str, str] | None = None) -> str:
    w = wheres or {}
    pieces = (
        (_T, ["frais_totaux"], "revenu_realise"), (_C, ["production_credit"], "production_credit"),
        (_E, ["nouveaux_clients"], "nouveaux_clients"),
        (_O, ["objectif_revenu", "objectif_nouveaux_clients", "objectif_production_credit"], None),
    )
    figures = ["revenu_realise", "production_credit", "nouveaux_clients", "objectif_revenu", "objectif_nouveaux_clients",
               "objectif_production_credit"]
    rows = []
    for fact, names, alias in pieces:
        have = {alias or n: n for n in names}
        cols = ", ".join([*by, *[f"{have[g]} as {g}" if g in have else f"null as {g}" for g in figures]])
        rows.append(f"select {cols} from ({star_sql(fact, names, by, w.get(fact, w.get('*', 'true')))}) q")
    sums = ", ".join(
        (f"{_big(f'sum({g})')} as {g}" if g.endswith("nouveaux_clients") else f"{_dec(f'sum({g})')} as {g}") for g in figures
    )
    group = f" group by {', '.join(by)}" if by else ""
    final = []
    for real, target, name in (("revenu_realise", "objectif_revenu", "revenu"),
                               ("production_credit", "objectif_production_credit", "production_credit"),
                               ("nouveaux_clients", "objectif_nouveaux_clients", "nouveaux_clients")):
        kind = "bigint" if name == "nouveaux_clients" else "decimal(38,2)"
        final += [real, target, f"cast({real} - {target} as {kind}) as ecart_{name}", f"{_ratio(real, target)} as taux_realisation_{name}"]
    return f"select {', '.join([*by, *final])} from (select {', '.join([*by, sums])} from ({' union all '.join(rows)}) u{group}) t"


@register("x4_performance_branch_month", performance_sql(["agence_id", "annee_mois"]))
def _(x: Context) -> DataFrame:
    return M.performance(x.mart, ["agence_id", "annee_mois"])


@register("x4_client_profile", profile_sql("segment"))
def _(x: Context) -> DataFrame:
    return M.client_profile(x.mart, ["segment"])


_UNPAID = f"""(select mois_debut, agence_id, nb_impayes from ({star_sql(_R, ['nb_impayes'], ['mois_debut', 'agence_id'])}) q where mois_debut is not null)"""


@register("x5_prior_year_by_branch", f"""select a.agence_id, a.mois_debut, a.nb_impayes, b.nb_impayes as nb_impayes_annee_precedente,
 a.nb_impayes - b.nb_impayes as evolution_nb_impayes,
 cast(a.nb_impayes - b.nb_impayes as double) / nullif(cast(b.nb_impayes as double), 0) as evolution_nb_impayes_pct
 from {_UNPAID} a left join {_UNPAID} b on a.agence_id = b.agence_id and a.mois_debut = cast(b.mois_debut + interval 12 month as date)""")
def _(x: Context) -> DataFrame:
    monthly = M.measure(x.mart, M.REPAYMENTS, ["nb_impayes"], ["mois_debut", "agence_id"]).where("mois_debut is not null")
    return M.prior_year(monthly, "nb_impayes", by=["agence_id"])


# ===================================================================== V: reports
def _monthly(fact: str, names: list[str], where: str = "true") -> str:
    return f"select * from ({star_sql(fact, names, ['mois_debut'], where)}) q where mois_debut is not null"


def _report(name: str, sql: str, fn) -> None:
    register(name, sql)(lambda x: fn(x.mart))


_report("v1_monthly_revenue", _monthly(_T, ["frais_totaux"]), reports.monthly_revenue)
_report("v1_top_branches", star_sql(_T, ["frais_totaux", "nb_transactions"], ["agence_id", "agence_libelle"])
        + " order by frais_totaux desc, agence_id limit 10", reports.top_branches)
_report("v1_transactions_by_type", star_sql(_T, ["nb_transactions", "flux_net", "frais_totaux"], ["type_transaction"]), reports.transactions_by_type)
_report("v1_attainment", performance_sql([]), reports.attainment)
_report("v2_monthly_transactions", _monthly(_T, ["nb_transactions", "montant_moyen", "nb_rejetees", "taux_rejet"]), reports.monthly_transactions)
_report("v2_debits_and_credits", _monthly(_T, ["montant_debits", "montant_credits", "flux_net"]), reports.debits_and_credits)
_report("v2_production_by_type", star_sql(_C, ["nb_credits", "production_credit", "montant_moyen_credit", "taux_annuel_moyen"], ["type_credit"]),
        reports.production_by_type)
_report("v2_transactions_by_channel", star_sql(_T, ["nb_transactions", "taux_rejet"], ["canal"]), reports.transactions_by_channel)
for _a in ("segment", "tranche_revenu", "niveau_risque"):
    _report(f"v3_clients_by_{_a}", profile_sql(_a), lambda mart, a=_a: reports.clients_by(mart, a))
_report("v3_most_used_products", f"select * from ({star_sql(_T, ['nb_transactions'], ['produit_id', 'produit_libelle'])}) q where produit_id <> 'INCONNU'"
        " order by nb_transactions desc, produit_id limit 10", reports.most_used_products)
_report("v4_monthly_unpaid", _monthly(_R, ["nb_echeances", "nb_impayes", "taux_impaye"]), reports.monthly_unpaid)
_report("v4_expected_and_paid", _monthly(_R, ["montant_attendu", "montant_paye", "montant_non_paye", "taux_recouvrement"]), reports.expected_and_paid)
_report("v4_latest_branches", star_sql(_R, ["nb_retards", "taux_retard", "jours_retard_moyens"], ["agence_id"])
        + " order by nb_retards desc, agence_id limit 10", reports.latest_branches)
_report("v4_branches_to_watch", f"""select r.* exclude (taux_impaye), o.seuil_impaye_pct_moyen, taux_impaye * 100 as taux_impaye_pct,
 coalesce(taux_impaye * 100 > o.seuil_impaye_pct_moyen, false) as a_surveiller
 from ({star_sql(_R, ['nb_echeances', 'nb_impayes', 'taux_impaye', 'montant_non_paye', 'taux_recouvrement'], ['agence_id'])}) r
 left join ({star_sql(_O, ['seuil_impaye_pct_moyen'], ['agence_id'])}) o on o.agence_id = r.agence_id""", reports.branches_to_watch)
_MATRIX = performance_sql(["agence_id", "agence_libelle"])
_report("v5_summary_matrix", _MATRIX, reports.branch_matrix)
_report("v5_production_against_target", f"""select agence_id, production_credit, objectif_production_credit, ecart_production_credit,
 taux_realisation_production_credit from ({_MATRIX}) z""", reports.branch_production)
_report("v5_new_clients_against_target", f"""select agence_id, nouveaux_clients, objectif_nouveaux_clients, ecart_nouveaux_clients,
 taux_realisation_nouveaux_clients from ({_MATRIX}) z""", reports.branch_new_clients)
_report("v5_revenue_gap", f"select agence_id, revenu_realise, objectif_revenu, ecart_revenu, taux_realisation_revenu from ({_MATRIX}) z",
        reports.branch_revenue_gap)
_ONE = "a.agence_id = 'A003'"
_report("v6_branch_detail", f"""select coalesce(p.mois_debut, r.mois_debut) as mois_debut, p.* exclude (mois_debut), r.* exclude (mois_debut)
 from (select * from ({performance_sql(['mois_debut'], {'*': _ONE})}) z where mois_debut is not null) p
 full join ({_monthly(_R, ['nb_echeances', 'nb_impayes', 'taux_impaye'], _ONE)}) r on r.mois_debut = p.mois_debut""",
        lambda mart: reports.branch_detail(mart, "A003"))
_measured("v7_slicers_risk", M.REPAYMENTS, ["annee", "type_credit"],
          filters={"annee": [1998, 1999], "categorie_agence": "Urbaine", "segment": ["Particulier", "Association"],
                   "statut_remboursement": ["Impayé", "Payé en retard"], "niveau_risque": "Faible"},
          where=f"annee in (1998, 1999) and categorie_agence = 'Urbaine' and segment in ('Particulier', 'Association')"
                f" and statut_remboursement in ('Impayé', 'Payé en retard') and ({_ATTR['niveau_risque']}) = 'Faible'")
_SLICE = "annee = 1999 and categorie_agence = 'Rurale'"


@register("v7_slicers_performance", performance_sql(["agence_id"], {
    "*": f"{_SLICE} and ({_ATTR['tranche_revenu']}) = '4 000 € et plus'", _O: _SLICE}))
def _(x: Context) -> DataFrame:
    """The income band narrows the facts that know a client; targets have none."""
    chosen = {"annee": 1999, "categorie_agence": "Rurale", "tranche_revenu": "4 000 € et plus"}
    return M.performance(x.mart, ["agence_id"], chosen)
