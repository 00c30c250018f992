"""The seven raw text tables derived from the driver tables, with planted dirt.

Each table is one SELECT over whole driver tables, written in the dialect
common to Spark and DuckDB (three helpers differ), so both engines see exactly
the same raw text. Dirt is planted by arithmetic on keys: damaged accents,
mixed case, outer spaces, blanks, repeated lines, orphan identifiers,
impossible dates and negative amounts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Lines that a task should group.
LINES_PER_TASK = 1 << 20
DRIVER_TABLES = ("nation", "region", "customer", "part", "orders", "lineitem", "events")


class SparkDialect:
    @staticmethod
    def add_months(d: str, n: str) -> str:
        return f"add_months({d}, cast({n} as int))"

    @staticmethod
    def minus_days(ts: str, n: str) -> str:
        return f"({ts} - make_dt_interval(cast({n} as int)))"

    @staticmethod
    def table(name: str) -> str:
        return "{" + name + "}"


class DuckDialect:
    @staticmethod
    def add_months(d: str, n: str) -> str:
        return f"cast({d} + to_months(cast({n} as integer)) as date)"

    @staticmethod
    def minus_days(ts: str, n: str) -> str:
        return f"({ts} - to_days(cast({n} as integer)))"

    @staticmethod
    def table(name: str) -> str:
        return name


def text(x: str) -> str:
    return f"concat('', {x})"


def ident(prefix: str, width: int, k: str) -> str:
    """Padded identifier that never truncates a longer number."""
    return f"concat('{prefix}', repeat('0', greatest({width} - length({text(k)}), 0)), {k})"


def money(cents: str) -> str:
    return (
        f"concat(case when {cents} < 0 then '-' else '' end, "
        f"cast(floor(abs({cents}) / 100) as bigint), '.', lpad({text(f'abs({cents}) % 100')}, 2, '0'))"
    )


def cents(x: str) -> str:
    return f"cast(round({x} * 100) as bigint)"


def _agences(q) -> str:
    n = "n_nationkey"
    return f"""
select concat(case when {n} % 7 = 0 then '  ' else '' end, {ident('A', 3, f'({n} + 1)')},
              case when {n} % 5 = 0 then ' ' else '' end) as agence_id,
  case {n} % 4 when 0 then concat('M├⌐rignac ', n_name) when 1 then concat('  Agence ', n_name, ' ')
       when 2 then concat('P├¬che ├á ', n_name) else n_name end as nom_agence,
  case when {n} = 23 then '' when {n} = 16 then concat('Ville √ ', n_name)
       when {n} % 3 = 0 then concat('Besan├ºon ', n_name) else concat('Ville ', n_name) end as ville,
  case {n} when 10 then 'ABCDE' when 21 then '3300' else {text(f'33000 + {n} * 100')} end as code_postal,
  concat(r_name, ' ├ëst') as departement,
  r_name as region,
  case {n} when 13 then '2026-13-40' when 14 then '' when 15 then '2097-01-01'
       else {text(f"date '1995-08-03' + cast({n} * 317 as int)")} end as date_ouverture,
  case {n} when 17 then '12.5' when 18 then '0' when 19 then ' ' else {text(f'7 + {n} % 21')} end as effectif,
  case when {n} = 24 then 'Littorale' when {n} = 22 then ''
       when {n} % 4 = 0 then 'URBAINE' when {n} % 4 = 1 then 'P├ëRIURBAINE'
       when {n} % 4 = 2 then 'rurale' else 'Périurbaine' end as categorie_agence
from {q.table('nation')} join {q.table('region')} on n_regionkey = r_regionkey"""


def _clients(q) -> str:
    k = "c_custkey"
    return f"""
select {text(f'{k} * 2 + copie')} as ligne_source,
  concat(case when {k} % 31 = 0 then ' ' else '' end, {ident('C', 6, k)}) as client_id,
  case {k} % 4 when 0 then 'H├⌐l├¿ne' when 1 then ' Fran├ºois' when 2 then 'Am├⌐lie ' else 'Paul' end as prenom,
  c_name as nom,
  case when {k} % 211 = 0 then '2002-01-01' when {k} % 313 = 0 then '1970-02-30'
       else {text(f"date '1940-01-01' + cast(({k} * 131) % 18000 as int)")} end as date_naissance,
  {text(f"date '1995-01-01' + cast(({k} * 37) % 2400 as int)")} as date_entree,
  case c_mktsegment when 'AUTOMOBILE' then 'Particulier' when 'BUILDING' then 'particulier'
       when 'FURNITURE' then 'Professionnel' when 'HOUSEHOLD' then 'ASSOCIATION'
       else 'Association' end as segment,
  case {k} % 12 when 0 then 'EMPLOY├ë' when 1 then 'Cadre' when 2 then 'Commer├ºant'
       when 3 then 'Retrait├⌐' when 4 then '├ëtudiant' when 5 then 'PROFESSION LIB├ëRALE'
       when 6 then 'Sans emploi' when 7 then 'TECHNICIEN' when 8 then 'Agriculteur'
       when 9 then 'artisan' when 10 then 'Enseignant' else 'Profession libérale' end as profession,
  case when {k} % 401 = 0 then '1e3' else {money(cents('c_acctbal'))} end as revenu_mensuel,
  case when {k} % 301 = 0 then '150' when {k} % 307 = 0 then 'abc'
       else {text(f'({k} * 7) % 101')} end as score_risque_initial,
  case when {k} % 97 = 0 then 'A999' else {ident('A', 3, '(c_nationkey + 1)')} end as agence_id,
  case when {k} % 5 = 0 then 'Orl├⌐ans' else ' Bordeaux' end as ville,
  case when {k} % 59 = 0 then '' else {text(f'10000 + {k} % 80000')} end as code_postal,
  case when {k} % 53 = 0 then ' ' when {k} % 61 = 0 then 'sans-arobase'
       else concat('Client', {k}, '@Banque.FR') end as email,
  case {k} % 4 when 0 then 'ACTIF' when 1 then 'Inactif' when 2 then 'clos' else 'Actif' end as statut_client
from (select *, 0 as copie from {q.table('customer')}
      union all select *, 1 as copie from {q.table('customer')} where c_custkey % 41 = 0) c"""


def _credits(q) -> str:
    k = "o_orderkey"
    months = f"(12 * (1 + {k} % 5))"
    end = q.add_months("cast(o_orderdate as date)", months)
    total = cents("o_totalprice")
    return f"""
select {text(f'{k} * 2 + copie')} as ligne_source,
  {ident('CR', 6, k)} as credit_id,
  case when {k} % 89 = 0 then 'CZ99999' else {ident('C', 6, 'o_custkey')} end as client_id,
  case when {k} % 60 = 0 then 'A999' else {ident('A', 3, '(o_custkey % 25 + 1)')} end as agence_id,
  case o_orderpriority when '1-URGENT' then 'Pr├¬t immobilier' when '2-HIGH' then 'PRÊT PERSONNEL'
       when '3-MEDIUM' then 'Prêt automobile' when '4-NOT SPECIFIED' then 'PR├èT IMMOBILIER'
       else 'Prêt personnel' end as type_credit,
  {text('cast(o_orderdate as date)')} as date_octroi,
  {money(total)} as montant_initial,
  case when {k} % 71 = 0 then '-1.500' when {k} % 719 = 0 then '3,2'
       else concat({k} % 9, '.', lpad({text(f'{k} % 1000')}, 3, '0')) end as taux_annuel,
  {text(months)} as duree_mois,
  {money(f'cast(floor({total} / {months}) as bigint)')} as mensualite_theorique,
  case when {k} % 467 = 0 then '101' else {text(f'({k} * 13) % 101')} end as score_risque_octroi,
  case o_orderstatus when 'F' then 'TERMIN├ë' when 'O' then 'en cours' else 'En cours' end as statut_credit,
  case when {k} % 251 = 0 then {text(f'{end} + 1')} else {text(end)} end as date_fin_prevue
from (select *, 0 as copie from {q.table('orders')}
      union all select *, 1 as copie from {q.table('orders')} where o_orderkey % 43 = 0) o"""


def _objectifs(q) -> str:
    return f"""
select concat({ident('A', 3, '(agence + 1)')}, case when agence % 6 = 0 then ' ' else '' end) as agence_id,
  mois,
  {money('nombre * 12345')} as objectif_revenu,
  case when (agence + nombre) % 37 = 0 then '12.5' else {text('nombre')} end as objectif_nouveaux_clients,
  {money('total')} as objectif_production_credit,
  concat(2 + nombre % 3, '.', lpad({text('(agence * 7 + nombre) % 100')}, 2, '0')) as seuil_taux_impaye_pct
from (select o_custkey % 26 as agence, substr({text('cast(o_orderdate as date)')}, 1, 7) as mois,
             count(*) as nombre, cast(sum({cents('o_totalprice')}) as bigint) as total
      from {q.table('orders')}
      group by o_custkey % 26, substr({text('cast(o_orderdate as date)')}, 1, 7)) g"""


def _produits(q) -> str:
    k = "p_partkey"
    code = ident("P", 3, k)
    return f"""
select case when {k} % 3 = 0 then lower({code}) when {k} % 5 = 0 then concat(' ', {code}) else {code} end as produit_id,
  case when {k} % 4 = 0 then concat('Livret r├⌐glement├⌐ ', p_name) else p_name end as nom_produit,
  case p_type when 'ECONOMY' then 'COMPTE' when 'SMALL' then 'carte' when 'MEDIUM' then '├ëpargne'
       when 'PROMO' then 'Cr├⌐dit' when 'STANDARD' then 'ASSURANCE'
       else case when {k} % 17 = 0 then 'Divers' else 'Crédit' end end as famille_produit,
  case p_type when 'ECONOMY' then '├ëPARGNE ET FLUX' when 'SMALL' then 'Moyens de paiement'
       when 'MEDIUM' then 'placement' when 'STANDARD' then 'Protection' else 'financement' end as univers,
  case when {k} % 401 = 0 then 'x' else {text('p_size % 5')} end as niveau_complexite
from {q.table('part')}"""


def _remboursements(q) -> str:
    m = "m"
    unpaid = f"{m} % 23 = 0"
    delay = f"(case when {m} % 3 = 0 then {m} % 31 else 0 end)"
    credit = ident("CR", 6, "k")
    code = ident("R", 8, m)
    return f"""
select case when {m} % 29 = 0 then lower({code}) else {code} end as remboursement_id,
  case when {m} % 83 = 0 then 'CRZ99999' when {m} % 17 = 0 then lower({credit})
       when {m} % 19 = 0 then concat(' ', {credit}) else {credit} end as credit_id,
  {text('d')} as date_echeance,
  case when {unpaid} then '' else {text(f'd + cast({delay} as int)')} end as date_paiement,
  case when {m} % 701 = 0 then '' else {money('total')} end as montant_attendu,
  case when {unpaid} then '0.00' when {m} % 101 = 0 then concat('-', {money('total')})
       when {m} % 37 = 0 then {money('cast(floor(total / 2) as bigint)')}
       when {m} % 613 = 0 then 'abc' when {m} % 211 = 0 then {money('(total + 100)')}
       else {money('total')} end as montant_paye,
  case when {m} % 127 = 0 then '' when {unpaid} then {text(f'30 + {m} % 60')}
       when {m} % 509 = 0 then {text(f'{delay} + 1')} else {text(delay)} end as jours_retard,
  case when {unpaid} then case when {m} % 2 = 0 then 'Impay├⌐' else 'IMPAYÉ' end
       when {delay} > 0 then case when {m} % 2 = 0 then 'Pay├⌐ en retard' else 'PAYÉ EN RETARD' end
       when {m} % 9 = 1 then 'paye a temps' else 'Pay├⌐ ├á temps' end as statut_remboursement
from (select l_orderkey as k, l_orderkey * 10 + l_linenumber as m,
             min(cast(l_shipdate as date)) as d,
             cast(sum({cents('l_extendedprice')}) as bigint) as total
      from {q.table('lineitem')} group by l_orderkey, l_linenumber) g"""


def _transactions(q) -> str:
    k = "event_id"
    amount = cents("value")
    stamp = q.minus_days("ts", f"{k} % 900")
    credit = "event_type = 'signup'"
    product = ident("P", 3, f"({k} % 200)")
    return f"""
select {text(f'{k} * 2 + copie')} as ligne_source,
  concat(case when {k} % 37 = 0 then ' ' else '' end, {ident('T', 9, k)}) as transaction_id,
  case when {k} % 67 = 0 then 'CZ99999' when {k} % 8 = 0 then lower({ident('C', 6, 'user_id')})
       else {ident('C', 6, 'user_id')} end as client_id,
  case when {k} % 370 = 0 then '2026-13-40 10:00:00'
       else {text(f"date_trunc('second', {stamp})")} end as date_transaction,
  case when {k} % 887 = 0 then 'Op├⌐ration diverse'
       when event_type = 'view' then 'PAIEMENT CARTE'
       when event_type = 'click' then case when {k} % 2 = 0 then 'Pr├⌐l├¿vement' else 'retrait dab' end
       when event_type = 'purchase' then case when {k} % 2 = 0 then 'Paiement carte' else 'Virement ├⌐mis' end
       when event_type = 'signup' then case {k} % 3 when 0 then 'VIREMENT REÇU' when 1 then 'D├⌐p├┤t'
            else 'Remboursement' end
       else 'Frais bancaires' end as type_transaction,
  case when {k} % 641 = 0 then '12,5' when {k} % 773 = 0 then '0.00'
       when ({credit}) = ({k} % 457 <> 0) then {money(amount)}
       else concat('-', {money(amount)}) end as montant,
  case when {k} % 991 = 0 then ''
       when {credit} then case {k} % 5 when 0 then 'CREDIT' when 1 then 'cr├⌐dit' else 'Crédit' end
       else case {k} % 5 when 0 then 'DEBIT' when 1 then 'd├⌐bit' else 'Débit' end end as sens,
  case when {k} % 13 = 0 then '' when {k} % 53 = 0 then 'PZ99'
       when {k} % 7 = 0 then lower({product}) else {product} end as produit_id,
  case when {k} % 97 = 0 then 'A999' when {k} % 11 = 0 then lower({ident('A', 3, '(user_id % 25 + 1)')})
       else {ident('A', 3, '(user_id % 25 + 1)')} end as agence_id,
  case {k} % 5 when 0 then 'APPLICATION MOBILE' when 1 then 'tpe' when 2 then 'web' when 3 then 'DAB'
       else 'Agence' end as canal,
  case {k} % 20 when 0 then 'Rejet├⌐e' when 1 then 'rejetee' when 2 then 'EN ATTENTE' when 3 then 'validee'
       when 4 then 'Valid├⌐e' else 'Validée' end as statut,
  case when {k} % 331 = 0 then '' when {k} % 337 = 0 then '2.50'
       when event_type = 'error' then {money(f'({amount} % 1000 + 100)')} else '0.00' end as frais,
  case when {k} % 1009 = 0 then 'USD' when {k} % 6 = 0 then 'eur ' else 'EUR' end as devise
from (select *, 0 as copie from {q.table('events')}
      union all select *, 1 as copie from {q.table('events')} where event_id % 101 = 0) e"""


_TEMPLATES = {
    "agences": _agences,
    "clients": _clients,
    "credits": _credits,
    "objectifs_agences": _objectifs,
    "produits": _produits,
    "remboursements": _remboursements,
    "transactions": _transactions,
}


def duck_raw_sql(table: str) -> str:
    return _TEMPLATES[table](DuckDialect).strip()


def instalments_together(lineitem: DataFrame) -> DataFrame:
    """The lines dealt out by the key they are grouped by, as many tasks as their number asks for.

    Few lines share a key, so a group made before the shuffle saves next to
    nothing and outgrows a task's memory. Small tables are left to Spark.
    """
    tasks = 1 + lineitem.count() // LINES_PER_TASK
    if tasks <= lineitem.sparkSession.sparkContext.defaultParallelism:
        return lineitem
    return lineitem.repartition(tasks, "l_orderkey", "l_linenumber")


def raw_layer(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Lazy raw tables over the Parquet files of one scale folder."""
    driver = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in DRIVER_TABLES}
    driver["lineitem"] = instalments_together(driver["lineitem"])
    return {
        name: spark.sql(
            sql := template(SparkDialect).strip(),
            **{t: df for t, df in driver.items() if "{" + t + "}" in sql},
        )
        for name, template in _TEMPLATES.items()
    }
