"""Independent SQL (DuckDB) statement of the warehouse, used only to check results.

``statement(final)`` puts the needed layers in front of a final SELECT as
common table expressions: ``raw_*`` -> ``stg_*`` -> ``dim_*`` / ``fact_*``.
"""

from __future__ import annotations

import re

from verification.testbed import duck_raw_sql

RAW_TABLES = (
    "agences", "clients", "credits", "objectifs_agences", "produits", "remboursements",
    "transactions",
)
# --- fixed values: damaged pair -> letter
MOJIBAKE = (
    ("├⌐", "é"),
    ("├¿", "è"),
    ("├º", "ç"),
    ("├ç", "Ç"),
    ("├ë", "É"),
    ("├è", "Ê"),
    ("├á", "à"),
    ("├¬", "ê"),
    ("├┤", "ô"),
)


def b2n(x: str) -> str:
    return f"nullif(trim({x}), '')"


def clean(x: str) -> str:
    out = b2n(x)
    for damaged, letter in MOJIBAKE:
        out = f"replace({out}, '{damaged}', '{letter}')"
    return out


def shaped(x: str, pattern: str, kind: str) -> str:
    return f"case when regexp_full_match({b2n(x)}, '{pattern}') then try_cast({b2n(x)} as {kind}) end"


def sdate(x: str) -> str:
    return shaped(x, "[0-9]{4}-[0-9]{2}-[0-9]{2}", "date")


def sts(x: str) -> str:
    return shaped(x, "[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}", "timestamp")


def sint(x: str) -> str:
    return shaped(x, "[+-]?[0-9]+", "integer")


def sdec(x: str, p: int, s: int) -> str:
    return shaped(x, r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)", f"decimal({p},{s})")


def smonth(x: str) -> str:
    return sdate(f"({b2n(x)} || '-01')")


def canon(x: str, labels: list[str], extra: dict[str, str] | None = None) -> str:
    pairs = {label.upper(): label for label in labels} | (extra or {})
    whens = " ".join(f"when '{k}' then '{v}'" for k, v in pairs.items())
    return f"case upper({x}) {whens} else {x} end"


CATEGORIES = ["Urbaine", "Périurbaine", "Rurale"]
SEGMENTS = ["Particulier", "Professionnel", "Association"]
PROFESSIONS = [
    "Agriculteur", "Artisan", "Cadre", "Commerçant", "Employé", "Enseignant",
    "Profession libérale", "Retraité", "Sans emploi", "Technicien", "Étudiant",
]
STATUTS_CLIENT = ["Actif", "Inactif", "Clos"]
TYPES_CREDIT = ["Prêt immobilier", "Prêt personnel", "Prêt automobile"]
STATUTS_CREDIT = ["En cours", "Terminé"]
FAMILLES = ["Compte", "Carte", "Épargne", "Crédit", "Assurance"]
UNIVERS = ["Épargne et flux", "Moyens de paiement", "Placement", "Financement", "Protection"]
STATUTS_REMB = ["Payé à temps", "Payé en retard", "Impayé"]
TYPES_TRANS = [
    "Paiement carte", "Prélèvement", "Virement reçu", "Virement émis", "Retrait DAB",
    "Remboursement", "Frais bancaires", "Dépôt",
]
CANAUX = ["Application mobile", "TPE", "Web", "DAB", "Agence"]
STATUTS_TRANS = ["Validée", "Rejetée", "En attente"]


def inlist(labels: list[str]) -> str:
    return "(" + ", ".join(f"'{x}'" for x in labels) + ")"


def _refs(table: str, column: str) -> str:
    return f"(select upper({b2n(column)}) from raw_{table} where {b2n(column)} is not null)"


def _known(x: str, table: str, column: str) -> str:
    return f"case when upper({x}) in {_refs(table, column)} then {x} end"


def _first(inner: str, key: str) -> str:
    part = f"coalesce({key}, 'SANS_ID_' || coalesce(cast(ligne_source as varchar), ''))"
    return (
        f"select * exclude (rang) from (select *, row_number() over "
        f"(partition by {part} order by ligne_source nulls first) as rang from ({inner}) t0) t1 where rang = 1"
    )


_CLIENTS = f"""select {sint('ligne_source')} as ligne_source, {clean('client_id')} as client_id,
 {clean('prenom')} as prenom, {clean('nom')} as nom, {sdate('date_naissance')} as date_naissance,
 {sdate('date_entree')} as date_entree, {clean('segment')} as segment, {clean('profession')} as profession,
 {sdec('revenu_mensuel', 12, 2)} as revenu_mensuel, {sint('score_risque_initial')} as score_risque_initial,
 {clean('agence_id')} as agence_id, {clean('ville')} as ville, {clean('code_postal')} as code_postal,
 {clean('email')} as email, {clean('statut_client')} as statut_client from raw_clients"""
_CREDITS = f"""select {sint('ligne_source')} as ligne_source, {clean('credit_id')} as credit_id,
 {clean('client_id')} as client_id, {clean('agence_id')} as agence_id, {clean('type_credit')} as type_credit,
 {sdate('date_octroi')} as date_octroi, {sdec('montant_initial', 15, 2)} as montant_initial,
 {sdec('taux_annuel', 6, 3)} as taux_annuel, {sint('duree_mois')} as duree_mois,
 {sdec('mensualite_theorique', 15, 2)} as mensualite_theorique, {sint('score_risque_octroi')} as score_risque_octroi,
 {clean('statut_credit')} as statut_credit, {sdate('date_fin_prevue')} as date_fin_prevue from raw_credits"""
_REMB = f"""select upper({clean('remboursement_id')}) as remboursement_id, upper({clean('credit_id')}) as credit_id,
 {sdate('date_echeance')} as date_echeance, {sdate('date_paiement')} as date_paiement,
 {sdec('montant_attendu', 15, 2)} as montant_attendu, {sdec('montant_paye', 15, 2)} as montant_paye,
 {sint('jours_retard')} as jours_retard, {clean('statut_remboursement')} as statut from raw_remboursements"""
_TRANS = f"""select {sint('ligne_source')} as ligne_source, upper({clean('transaction_id')}) as transaction_id,
 upper({clean('client_id')}) as client_id, {sts('date_transaction')} as date_transaction,
 {clean('type_transaction')} as type_transaction, {sdec('montant', 15, 2)} as montant, {clean('sens')} as sens,
 upper({clean('produit_id')}) as produit_id, upper({clean('agence_id')}) as agence_id, {clean('canal')} as canal,
 {clean('statut')} as statut, {sdec('frais', 15, 2)} as frais, upper({clean('devise')}) as devise from raw_transactions"""

_DATES = " union all ".join(
    f"select cast({c} as date) as d from stg_{t}"
    for t, c in (
        ("clients", "date_entree"), ("transactions", "date_transaction"), ("credits", "date_octroi"),
        ("credits", "date_fin_prevue"), ("remboursements", "date_echeance"),
        ("remboursements", "date_paiement"), ("objectifs_agences", "mois"),
    )
)
_DAYS = "['Lundi','Mardi','Mercredi','Jeudi','Vendredi','Samedi','Dimanche']"
_MONTHS = (
    "['Janvier','Février','Mars','Avril','Mai','Juin','Juillet','Août','Septembre','Octobre',"
    "'Novembre','Décembre']"
)


def _date_key(alias: str, d: str) -> str:
    return f"left join dim_date {alias} on {alias}.date_complete = {d}"


CTES: dict[str, str] = {f"raw_{t}": duck_raw_sql(t) for t in RAW_TABLES}
CTES |= {
    "stg_agences": f"""select {clean('agence_id')} as agence_id, {clean('nom_agence')} as nom_agence,
 {clean('ville')} as ville, {clean('code_postal')} as code_postal, {clean('departement')} as departement,
 {clean('region')} as region, {sdate('date_ouverture')} as date_ouverture, {sint('effectif')} as effectif,
 {canon(clean('categorie_agence'), CATEGORIES)} as categorie_agence from raw_agences""",
    "stg_clients": f"""select ligne_source, client_id, prenom, nom, date_naissance, date_entree,
 {canon('segment', SEGMENTS)} as segment, {canon('profession', PROFESSIONS)} as profession,
 case when revenu_mensuel < 0 then null else revenu_mensuel end as revenu_mensuel, score_risque_initial,
 agence_id, ville, code_postal, lower(email) as email, {canon('statut_client', STATUTS_CLIENT)} as statut_client
 from ({_first(_CLIENTS, 'client_id')}) s""",
    "stg_credits": f"""select ligne_source, credit_id, {_known('client_id', 'clients', 'client_id')} as client_id,
 {_known('agence_id', 'agences', 'agence_id')} as agence_id, {canon('type_credit', TYPES_CREDIT)} as type_credit,
 date_octroi, montant_initial, case when taux_annuel < 0 then null else taux_annuel end as taux_annuel,
 duree_mois, mensualite_theorique, score_risque_octroi, {canon('statut_credit', STATUTS_CREDIT)} as statut_credit,
 date_fin_prevue from ({_first(_CREDITS, 'credit_id')}) s""",
    "stg_objectifs_agences": f"""select {b2n('agence_id')} as agence_id, {smonth('mois')} as mois,
 {sdec('objectif_revenu', 15, 2)} as objectif_revenu, {sint('objectif_nouveaux_clients')} as objectif_nouveaux_clients,
 {sdec('objectif_production_credit', 15, 2)} as objectif_production_credit,
 {sdec('seuil_taux_impaye_pct', 5, 2)} as seuil_taux_impaye_pct from raw_objectifs_agences""",
    "stg_produits": f"""select upper({clean('produit_id')}) as produit_id, {clean('nom_produit')} as nom_produit,
 {canon(clean('famille_produit'), FAMILLES)} as famille_produit, {canon(clean('univers'), UNIVERS)} as univers,
 {sint('niveau_complexite')} as niveau_complexite from raw_produits""",
    "stg_remboursements": f"""select remboursement_id, {_known('credit_id', 'credits', 'credit_id')} as credit_id,
 date_echeance, date_paiement, montant_attendu,
 case when montant_paye < 0 then null else montant_paye end as montant_paye, jours_retard,
 case when date_paiement is null or montant_paye = 0 then 'Impayé' when jours_retard > 0 then 'Payé en retard'
 when jours_retard = 0 then 'Payé à temps'
 else {canon('statut', STATUTS_REMB, {'PAYE A TEMPS': 'Payé à temps'})} end as statut_remboursement
 from ({_REMB}) s""",
    "stg_transactions": f"""select ligne_source, transaction_id, {_known('client_id', 'clients', 'client_id')} as client_id,
 date_transaction, {canon('type_transaction', TYPES_TRANS)} as type_transaction, montant,
 {canon('sens', ['Débit', 'Crédit'], {'DEBIT': 'Débit', 'CREDIT': 'Crédit'})} as sens,
 {_known('produit_id', 'produits', 'produit_id')} as produit_id, {_known('agence_id', 'agences', 'agence_id')} as agence_id,
 {canon('canal', CANAUX)} as canal,
 {canon('statut', STATUTS_TRANS, {'VALIDEE': 'Validée', 'REJETEE': 'Rejetée'})} as statut, frais, devise
 from ({_first(_TRANS, 'transaction_id')}) s""",
    "date_bounds": f"select min(d) as date_min, max(d) as date_max from ({_DATES}) t",
    "dim_date": f"""select cast(strftime(d, '%Y%m%d') as integer) as date_key, d as date_complete,
 cast(day(d) as smallint) as jour_numero, cast(isodow(d) as smallint) as jour_semaine_numero,
 ({_DAYS})[isodow(d)] as nom_jour, cast(weekofyear(d) as smallint) as semaine_iso,
 cast(month(d) as smallint) as mois_numero, ({_MONTHS})[month(d)] as nom_mois,
 cast(quarter(d) as smallint) as trimestre_numero, 'T' || quarter(d) as trimestre_libelle,
 cast(case when month(d) <= 6 then 1 else 2 end as smallint) as semestre_numero,
 cast(year(d) as smallint) as annee, cast(year(d) * 100 + month(d) as integer) as annee_mois,
 strftime(d, '%Y-%m') as annee_mois_libelle, cast(date_trunc('month', d) as date) as mois_debut,
 isodow(d) >= 6 as est_weekend, strftime(d, '%d/%m/%Y') as libelle_date
 from (select cast(unnest(generate_series(coalesce(date_min, date '2021-01-01'),
 coalesce(date_max, date '2026-12-31'), interval 1 day)) as date) as d from date_bounds) t
 union all select 0, null, null, null, 'Inconnu', null, null, 'Inconnu', null, null, null, null, null, null,
 null, null, 'Date inconnue'""",
    "dim_agence": """select cast(row_number() over (order by agence_id) as bigint) as agence_key, * from stg_agences
 union all select 0, 'INCONNUE', 'Agence inconnue', 'Inconnue', null, 'Inconnu', 'Inconnue', null, null, 'Inconnue'""",
    "dim_client": """select cast(row_number() over (order by client_id) as bigint) as client_key, client_id, prenom, nom,
 trim(concat(prenom, ' ', nom)) as nom_complet, date_naissance, date_entree, segment, profession, revenu_mensuel,
 score_risque_initial, agence_id as agence_rattachement_id, ville, code_postal, email, statut_client from stg_clients
 union all select 0, 'INCONNU', 'Client', 'Inconnu', 'Client inconnu', null, null, 'Inconnu', 'Inconnue', null, null,
 'INCONNUE', 'Inconnue', null, null, 'Inconnu'""",
    "dim_produit": """select cast(row_number() over (order by produit_id) as bigint) as produit_key, * from stg_produits
 union all select 0, 'INCONNU', 'Produit inconnu', 'Inconnue', 'Inconnu', null""",
    "fact_transactions": f"""select transaction_id, coalesce(d.date_key, 0) as date_key,
 coalesce(c.client_key, 0) as client_key, coalesce(p.produit_key, 0) as produit_key,
 coalesce(a.agence_key, 0) as agence_key, type_transaction, montant as montant_signe,
 cast(case when sens = 'Débit' then coalesce(abs(montant), 0) else 0 end as decimal(15,2)) as montant_debit,
 cast(case when sens = 'Crédit' then coalesce(abs(montant), 0) else 0 end as decimal(15,2)) as montant_credit,
 sens, canal, statut, frais, devise, cast(1 as smallint) as nombre_transactions
 from stg_transactions t {_date_key('d', 'cast(t.date_transaction as date)')}
 left join dim_client c on c.client_id = t.client_id and c.client_key <> 0
 left join dim_produit p on p.produit_id = t.produit_id and p.produit_key <> 0
 left join dim_agence a on a.agence_id = t.agence_id and a.agence_key <> 0""",
    "fact_credits": f"""select credit_id, coalesce(d1.date_key, 0) as date_octroi_key,
 coalesce(d2.date_key, 0) as date_fin_prevue_key, coalesce(c.client_key, 0) as client_key,
 coalesce(a.agence_key, 0) as agence_key, type_credit, montant_initial, taux_annuel, duree_mois,
 mensualite_theorique, score_risque_octroi, statut_credit, cast(1 as smallint) as nombre_credits
 from stg_credits t {_date_key('d1', 't.date_octroi')} {_date_key('d2', 't.date_fin_prevue')}
 left join dim_client c on c.client_id = t.client_id and c.client_key <> 0
 left join dim_agence a on a.agence_id = t.agence_id and a.agence_key <> 0""",
    "fact_remboursements": f"""select remboursement_id, t.credit_id, coalesce(d1.date_key, 0) as date_echeance_key,
 coalesce(d2.date_key, 0) as date_paiement_key, coalesce(c.client_key, 0) as client_key,
 coalesce(a.agence_key, 0) as agence_key, cr.type_credit, cr.statut_credit, montant_attendu, montant_paye,
 cast(case when montant_paye is null then null when montant_attendu - montant_paye < 0 then 0
 else montant_attendu - montant_paye end as decimal(15,2)) as montant_non_paye, jours_retard, statut_remboursement,
 coalesce(statut_remboursement = 'Impayé', false) as est_impaye,
 coalesce(statut_remboursement = 'Payé en retard', false) as est_en_retard, cast(1 as smallint) as nombre_echeances
 from stg_remboursements t left join stg_credits cr on cr.credit_id = t.credit_id
 {_date_key('d1', 't.date_echeance')} {_date_key('d2', 't.date_paiement')}
 left join dim_client c on c.client_id = cr.client_id and c.client_key <> 0
 left join dim_agence a on a.agence_id = cr.agence_id and a.agence_key <> 0""",
    "fact_objectifs_agences": f"""select coalesce(d.date_key, 0) as date_key, coalesce(a.agence_key, 0) as agence_key,
 objectif_revenu, objectif_nouveaux_clients, objectif_production_credit, seuil_taux_impaye_pct,
 cast(1 as smallint) as nombre_lignes_objectif from stg_objectifs_agences t {_date_key('d', 't.mois')}
 left join dim_agence a on a.agence_id = t.agence_id and a.agence_key <> 0""",
    "fact_entrees_clients": f"""select coalesce(d.date_key, 0) as date_key, coalesce(c.client_key, 0) as client_key,
 coalesce(a.agence_key, 0) as agence_key, cast(1 as smallint) as nombre_nouveaux_clients
 from stg_clients t {_date_key('d', 't.date_entree')}
 left join dim_client c on c.client_id = t.client_id and c.client_key <> 0
 left join dim_agence a on a.agence_id = t.agence_id and a.agence_key <> 0""",
}
_NAMES = list(CTES)


def statement(final: str, extra: dict[str, str] | None = None) -> str:
    """``final`` preceded by the layers it needs, directly or through others."""
    bodies = CTES | (extra or {})
    names = _NAMES + [n for n in (extra or {}) if n not in CTES]
    wanted: set[str] = set()
    pending = [final]
    while pending:
        words = set(re.findall(r"[a-z_0-9]+", pending.pop()))
        for name in words & set(bodies) - wanted:
            wanted.add(name)
            pending.append(bodies[name])
    if not wanted:
        return final.strip()
    listed = ",\n".join(f"{n} as materialized (\n{bodies[n]}\n)" for n in names if n in wanted)
    return f"with {listed}\n{final.strip()}"
