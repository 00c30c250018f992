"""Every registered query: a function of the layers, and its oracle SQL where SQL can state it."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions import dates, domains, parsing, rules, text
from ledgerflow.functions import predicates as P
from ledgerflow.operators import dedup, grouping, lookup
from ledgerflow.operators.checks import unpivot
from ledgerflow.plans import calendar, controls, dimensions, facts, guards, quality, staging
from ledgerflow.plans import measures as M
from ledgerflow.sources import layers, publish, text_files
from ledgerflow.sources.delivery import read_extract
from ledgerflow.sources.schemas import RAW_COLUMNS
from verification import oracle as O
from verification.context import Context
from verification.oracle import statement

AS_OF = "2026-06-30"

QUERIES: dict[str, Callable[[Context], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None, extra: dict[str, str] | None = None):
    def keep(fn: Callable[[Context], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = statement(sql, extra)
        return fn

    return keep


def _select(table: str) -> str:
    return f"select * from {table}"


# ============================================================ sources and sinks
def _cells(table: str) -> str:
    """A row as one text: missing and empty cells are the same in a CSV file."""
    return "concat_ws('|', " + ", ".join(f"coalesce({c}, '')" for c in RAW_COLUMNS[table]) + ")"


_EVERY_ROW = " union all ".join(f"select '{t}' as nom_table, {_cells(t)} as ligne from raw_{t}" for t in RAW_COLUMNS)


def _every_row(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(
        DataFrame.union, [df.select(F.lit(t).alias("nom_table"), F.expr(_cells(t)).alias("ligne")) for t, df in tables.items()]
    )


@register("a1_csv_ingest", _EVERY_ROW)
def _(x: Context) -> DataFrame:
    """All seven extracts written and read back."""
    for table, df in x.raw.items():
        text_files.write_raw_csv(df, f"{x.root}/extracts/{table}")
    return _every_row({t: text_files.read_raw_csv(x.spark, t, f"{x.root}/extracts/{t}") for t in x.raw})


# Records broken by the last character of their identifier: a cell too many, or one too few.
_DAMAGE = {"surplus": "ascii(right(trim(remboursement_id), 1)) % 7 = 0", "short": "ascii(right(trim(remboursement_id), 1)) % 7 = 1"}
_CELLS = ", ".join(f"coalesce({c}, '')" for c in RAW_COLUMNS["remboursements"])
_SHORT = ", ".join(f"coalesce({c}, '')" for c in RAW_COLUMNS["remboursements"][:-1])


@register("a1_rejected_records", f"""select cast({len(RAW_COLUMNS['remboursements'])} + 1 as bigint) as cellules, concat_ws(',', {_CELLS}, 'x') as enregistrement
 from raw_remboursements where {_DAMAGE['surplus']}
 union all select cast({len(RAW_COLUMNS['remboursements'])} - 1 as bigint), concat_ws(',', {_SHORT})
 from raw_remboursements where not ({_DAMAGE['surplus']}) and {_DAMAGE['short']}
 union all select cast(0 as bigint), {_cells('remboursements')} from raw_remboursements
 where not coalesce({_DAMAGE['surplus']}, false) and not coalesce({_DAMAGE['short']}, false)""")
def _(x: Context) -> DataFrame:
    """All repayments as a delivery with broken records: what is rejected as received, and (0 cells) what loads."""
    surplus, short = F.expr(_DAMAGE["surplus"]), F.expr(_DAMAGE["short"])
    cells, fewer = F.expr(f"concat_ws(',', {_CELLS})"), F.expr(f"concat_ws(',', {_SHORT})")
    record = F.when(surplus, F.concat(cells, F.lit(",x"))).when(short, fewer).otherwise(cells)
    path = f"{x.root}/broken/remboursements"
    lines = x.raw["remboursements"].select(record.alias("value"))
    lines.write.mode("overwrite").text(path)
    delivery = read_extract(x.spark, "remboursements", path, header=False)
    loaded = _every_row(delivery.tables).select(F.lit(0).cast("bigint").alias("cellules"), F.col("ligne").alias("enregistrement"))
    return delivery.rejects.select("cellules", "enregistrement").unionByName(loaded)


def _columns_sql(table: str) -> str:
    return f"raw_{table} unpivot include nulls (valeur for colonne in (columns(*)))"


@register("a2_raw_schemas", " union all ".join(
    f"select '{t}' as nom_table, colonne, count(valeur) as renseignes from {_columns_sql(t)} group by colonne" for t in RAW_COLUMNS))
def _(x: Context) -> DataFrame:
    """Every column of every raw table, as the manifest has it, with its given values."""
    parts = []
    for table, df in x.raw.items():
        counts = df.agg(*[F.count(c).alias(c) for c in x.raw.info[table].column_names])
        parts.append(unpivot(counts).select(F.lit(table).alias("nom_table"), F.col("mesure").alias("colonne"), F.col("valeur").alias("renseignes")))
    return reduce(DataFrame.union, parts)


@register("a3_full_reload", _EVERY_ROW)
def _(x: Context) -> DataFrame:
    """The whole delivery loaded twice: the second load replaces the first."""
    root = f"{x.root}/reload"
    for _run in range(2):
        publish.publish(x.spark, root, dict(x.raw))
    return _every_row(publish.read_published(x.spark, root))


@register("a4_atomic_publication", _EVERY_ROW)
def _(x: Context) -> DataFrame:
    """A failed verification leaves the first version of every table current."""
    root = f"{x.root}/atomic"
    publish.publish(x.spark, root, dict(x.raw))

    def refuse(_written: dict[str, DataFrame]) -> None:
        raise guards.GuardFailed("refused")

    try:
        publish.publish(x.spark, root, {t: df.union(df) for t, df in x.raw.items()}, verify=refuse)
    except guards.GuardFailed:
        pass
    return _every_row(publish.read_published(x.spark, root))


@register("a5_a8_layers_and_columns", " union all ".join(
    f"select '{t}' as nom_table, count(distinct colonne) as nombre_colonnes from {_columns_sql(t)}" for t in RAW_COLUMNS))
def _(x: Context) -> DataFrame:
    """Layer databases in the shared folder, all raw tables loaded twice, columns from the catalog."""
    prefix = f"bank_{uuid.uuid4().hex[:8]}_"
    for _run in range(2):
        layers.create_layers(x.spark, prefix, f"{x.root}/catalog")
        for table in x.raw:
            layers.replace_table(x.raw[table], f"{prefix}raw.{table}")
    layers.require_tables(x.spark, [(f"{prefix}raw.{t}", "raw load") for t in x.raw])
    return layers.catalog_column_report(x.spark, f"{prefix}raw")


@register("a6_literal_rows", """select agence_id, nom_agence, ville, region from dim_agence where agence_key = 0""")
def _(x: Context) -> DataFrame:
    return x.dims["dim_agence"].where("agence_key = 0").select("agence_id", "nom_agence", "ville", "region")


@register("a7_volume_report", " union all ".join(
    f"select '{t}' as nom_table, cast(count(*) as bigint) as nombre_lignes from raw_{t}" for t in RAW_COLUMNS))
def _(x: Context) -> DataFrame:
    return layers.volume_report(x.raw)


_LAYERED = {
    **{f"raw.{t}": f"raw_{t}" for t in RAW_COLUMNS},
    **{f"staging.{t}": f"stg_{t}" for t in RAW_COLUMNS},
    **{f"mart.{t}": t for t in ("dim_date", "dim_agence", "dim_client", "dim_produit", "fact_transactions", "fact_credits",
                                "fact_remboursements", "fact_objectifs_agences", "fact_entrees_clients")},
}
_WANTED = "select nom_table from (values " + ", ".join(f"('{t}')" for t in (*_LAYERED, "mart.fact_virements")) + ") v(nom_table)"
_PRESENT = " union all ".join(f"select distinct '{name}' as nom_table from {table}" for name, table in _LAYERED.items())


def _present(x: Context) -> DataFrame:
    """The tables of all layers whose files are there and, by the manifest, hold rows."""
    named = {"raw": x.raw, "staging": x.staging, "mart": x.mart}
    rows = [(layer, f"{layer}.{t}") for layer, tables in named.items() for t in tables.present() if tables.info[t].rows]
    return x.spark.createDataFrame(rows, "couche string, nom_table string")


@register("a9_required_tables", f"""select count(*) as tables_manquantes,
 string_agg(nom_table || ' — créée par ' || case when nom_table like 'mart.dim%' then 'dimensions' when nom_table like 'mart%' then 'facts'
  else split_part(nom_table, '.', 1) end, ' ; ' order by nom_table) as message
 from ({_WANTED}) w where nom_table not in ({_PRESENT})""")
def _(x: Context) -> DataFrame:
    """The tables of the three layers and one that no job creates."""
    raw = [(f"raw.{t}", "raw") for t in RAW_COLUMNS]
    wanted = [*raw, *controls.REQUIRED, ("mart.fact_virements", "facts")]
    required = x.spark.createDataFrame(wanted, "nom_table string, createur string")
    return layers.missing_tables_message(_present(x), required)


@register("g14_listed_tables", f"""select split_part(nom_table, '.', 1) as couche, string_agg(nom_table, ' ; ' order by nom_table) as tables_presentes
 from ({_PRESENT}) p group by 1""")
def _(x: Context) -> DataFrame:
    listed = F.concat_ws(" ; ", F.array_sort(F.collect_list("nom_table")))
    return _present(x).groupBy("couche").agg(listed.alias("tables_presentes"))


@register("a9_volumes_of_all_layers", " union all ".join(
    f"select '{name}' as nom_table, count(*) as nombre_lignes from {table}" for name, table in _LAYERED.items()))
def _(x: Context) -> DataFrame:
    """What the manifests of the three layers say, against the rows themselves."""
    named = {"raw": x.raw, "staging": x.staging, "mart": x.mart}
    return reduce(DataFrame.union, [
        layers.volume_report(tables).select(F.concat(F.lit(f"{layer}."), "nom_table").alias("nom_table"), "nombre_lignes")
        for layer, tables in named.items()
    ])


@register("a10_sample_preview", "select * from raw_clients order by client_id, ligne_source limit 10")
def _(x: Context) -> DataFrame:
    return layers.preview(x.raw["clients"], 10, "client_id", "ligne_source")


# ===================================================== projections and cleaning
@register("b1_clean_text", f"""select ligne_source, {O.clean('prenom')} as prenom, {O.clean('profession')} as profession,
 {O.clean('ville')} as ville, {O.clean('email')} as email from raw_clients""")
def _(x: Context) -> DataFrame:
    cleaned = [text.clean_text(F.col(c)).alias(c) for c in ("prenom", "profession", "ville", "email")]
    return x.raw["clients"].select("ligne_source", *cleaned)


@register("b2_blank_to_null", f"""select ligne_source, {O.b2n('produit_id')} as produit_id, {O.b2n('sens')} as sens,
 {O.b2n('frais')} as frais from raw_transactions""")
def _(x: Context) -> DataFrame:
    blanks = [text.blank_to_null(F.col(c)).alias(c) for c in ("produit_id", "sens", "frais")]
    return x.raw["transactions"].select("ligne_source", *blanks)


@register("b3_b5_safe_date_int", f"""select remboursement_id, {O.sdate('date_echeance')} as date_echeance,
 {O.sdate('date_paiement')} as date_paiement, {O.sint('jours_retard')} as jours_retard from raw_remboursements""")
def _(x: Context) -> DataFrame:
    return x.raw["remboursements"].select(
        "remboursement_id",
        parsing.safe_date(F.col("date_echeance")).alias("date_echeance"),
        parsing.safe_date(F.col("date_paiement")).alias("date_paiement"),
        parsing.safe_int(F.col("jours_retard")).alias("jours_retard"),
    )


@register("b4_b6_safe_timestamp_decimal", f"""select ligne_source, {O.sts('date_transaction')} as date_transaction,
 {O.sdec('montant', 15, 2)} as montant, {O.sdec('frais', 15, 2)} as frais from raw_transactions""")
def _(x: Context) -> DataFrame:
    return x.raw["transactions"].select(
        "ligne_source",
        parsing.safe_timestamp(F.col("date_transaction")).alias("date_transaction"),
        parsing.safe_decimal(F.col("montant"), 15, 2).alias("montant"),
        parsing.safe_decimal(F.col("frais"), 15, 2).alias("frais"),
    )


@register("b7_month_start", f"select {O.b2n('agence_id')} as agence_id, {O.smonth('mois')} as mois from raw_objectifs_agences")
def _(x: Context) -> DataFrame:
    return x.raw["objectifs_agences"].select(
        text.blank_to_null(F.col("agence_id")).alias("agence_id"),
        parsing.month_start(F.col("mois")).alias("mois"),
    )


@register("b8_canonical_labels", f"""select ligne_source, {O.canon(O.clean('type_transaction'), O.TYPES_TRANS)} as type_transaction,
 {O.canon(O.clean('sens'), ['Débit', 'Crédit'], {'DEBIT': 'Débit', 'CREDIT': 'Crédit'})} as sens,
 {O.canon(O.clean('canal'), O.CANAUX)} as canal,
 {O.canon(O.clean('statut'), O.STATUTS_TRANS, {'VALIDEE': 'Validée', 'REJETEE': 'Rejetée'})} as statut
 from raw_transactions""")
def _(x: Context) -> DataFrame:
    maps = {
        "type_transaction": domains.spelling_map(domains.TYPE_TRANSACTION),
        "sens": domains.spelling_map(domains.SENS, domains.UNACCENTED_SENS),
        "canal": domains.spelling_map(domains.CANAL),
        "statut": domains.spelling_map(domains.STATUT_TRANSACTION, domains.UNACCENTED_STATUT_TRANSACTION),
    }
    labels = [text.canonical(text.clean_text(F.col(c)), m).alias(c) for c, m in maps.items()]
    return x.raw["transactions"].select("ligne_source", *labels)


@register("b9_b10_codes_and_email", f"""select upper({O.clean('t.produit_id')}) as produit_id,
 upper({O.clean('t.devise')}) as devise, lower({O.clean('c.email')}) as email, cast(count(*) as bigint) as nombre
 from raw_transactions t join raw_clients c on {O.b2n('c.client_id')} = upper({O.b2n('t.client_id')})
 group by 1, 2, 3""")
def _(x: Context) -> DataFrame:
    t = x.raw["transactions"].select(
        text.reference_key(F.col("client_id")).alias("k"),
        text.clean_code(F.col("produit_id")).alias("produit_id"),
        text.clean_code(F.col("devise")).alias("devise"),
    )
    c = x.raw["clients"].select(
        text.reference_key(F.col("client_id")).alias("k"),
        F.lower(text.clean_text(F.col("email"))).alias("email"),
    )
    return t.join(c, "k").groupBy("produit_id", "devise", "email").agg(F.count(F.lit(1)).alias("nombre"))


@register("b11_negative_to_null", f"""select credit_id, ligne_source, {O.sdec('taux_annuel', 6, 3)} as taux_source,
 case when {O.sdec('taux_annuel', 6, 3)} < 0 then null else {O.sdec('taux_annuel', 6, 3)} end as taux_annuel
 from raw_credits""")
def _(x: Context) -> DataFrame:
    rate = parsing.safe_decimal(F.col("taux_annuel"), 6, 3)
    return x.raw["credits"].select(
        "credit_id", "ligne_source", rate.alias("taux_source"), rules.null_if_negative(rate).alias("taux_annuel")
    )


@register("b12_repayment_status", "select remboursement_id, montant_paye, jours_retard, statut_remboursement from stg_remboursements")
def _(x: Context) -> DataFrame:
    paid = parsing.safe_decimal(F.col("montant_paye"), 15, 2)
    delay = parsing.safe_int(F.col("jours_retard"))
    status = rules.repayment_status(
        paid, parsing.safe_date(F.col("date_paiement")), delay, text.clean_text(F.col("statut_remboursement"))
    )
    return x.raw["remboursements"].select(
        text.clean_code(F.col("remboursement_id")).alias("remboursement_id"),
        rules.null_if_negative(paid).alias("montant_paye"),
        delay.alias("jours_retard"),
        status.alias("statut_remboursement"),
    )


@register("b13_debit_credit", """select transaction_id,
 cast(case when sens = 'Débit' then coalesce(abs(montant), 0) else 0 end as decimal(15,2)) as montant_debit,
 cast(case when sens = 'Crédit' then coalesce(abs(montant), 0) else 0 end as decimal(15,2)) as montant_credit
 from stg_transactions""")
def _(x: Context) -> DataFrame:
    side, value = F.col("sens"), F.col("montant")
    return x.staging["transactions"].select(
        "transaction_id",
        rules.side_amount(side, value, "Débit").alias("montant_debit"),
        rules.side_amount(side, value, "Crédit").alias("montant_credit"),
    )


@register("b14_b15_unpaid_and_flags", """select remboursement_id, montant_non_paye, est_impaye, est_en_retard from fact_remboursements""")
def _(x: Context) -> DataFrame:
    status = F.col("statut_remboursement")
    return x.staging["remboursements"].select(
        "remboursement_id",
        rules.unpaid_amount(F.col("montant_attendu"), F.col("montant_paye")).alias("montant_non_paye"),
        rules.is_status(status, rules.IMPAYE).alias("est_impaye"),
        rules.is_status(status, rules.EN_RETARD).alias("est_en_retard"),
    )


@register("b16_full_name", "select client_id, nom_complet from dim_client where client_key <> 0")
def _(x: Context) -> DataFrame:
    return x.staging["clients"].select(
        "client_id", text.full_name(F.col("prenom"), F.col("nom")).alias("nom_complet")
    )


@register("b17_b18_counter_and_unknown_key", """select agence_key, cast(sum(nombre_transactions) as bigint) as nombre_transactions
 from fact_transactions group by agence_key""")
def _(x: Context) -> DataFrame:
    keyed = lookup.resolve_key(
        x.staging["transactions"].select("agence_id"), F.col("agence_id"), x.dims["dim_agence"],
        "agence_id", "agence_key", "agence_key",
    )
    counted = keyed.withColumn("nombre_transactions", rules.counter())
    return counted.groupBy("agence_key").agg(F.sum("nombre_transactions").alias("nombre_transactions"))


@register("b19_display_labels", """select agence_id as id, concat_ws(' - ', agence_id, nom_agence) as libelle from dim_agence
 union all select produit_id, concat_ws(' - ', produit_id, nom_produit) from dim_produit""")
def _(x: Context) -> DataFrame:
    a = M.dimension(x.mart, "dim_agence").select(F.col("agence_id").alias("id"), F.col("agence_libelle").alias("libelle"))
    p = M.dimension(x.mart, "dim_produit").select(F.col("produit_id").alias("id"), F.col("produit_libelle").alias("libelle"))
    return a.unionByName(p)


BAND = """case when revenu_mensuel < 1500 then 'Moins de 1 500 €' when revenu_mensuel < 2500 then 'De 1 500 € à 2 499 €'
 when revenu_mensuel < 4000 then 'De 2 500 € à 3 999 €' when revenu_mensuel >= 4000 then '4 000 € et plus' else 'Inconnu' end"""
LEVEL = """case when score_risque_initial < 40 then 'Faible' when score_risque_initial < 70 then 'Modéré'
 when score_risque_initial >= 70 then 'Élevé' else 'Inconnu' end"""


@register("b20_b21_bands", f"select client_id, {BAND} as tranche_revenu, {LEVEL} as niveau_risque from stg_clients")
def _(x: Context) -> DataFrame:
    return x.staging["clients"].select(
        "client_id",
        rules.income_band(F.col("revenu_mensuel")).alias("tranche_revenu"),
        rules.risk_level(F.col("score_risque_initial")).alias("niveau_risque"),
    )


@register("b22_messages", """select cast(credit_id as varchar) as credit_id,
 concat('Crédit ', credit_id, ' : ', cast(montant_initial as varchar), ' EUR sur ', cast(duree_mois as varchar), ' mois, taux ',
 cast(taux_annuel as varchar), '.') as message from stg_credits""")
def _(x: Context) -> DataFrame:
    return x.staging["credits"].select(
        "credit_id",
        text.message("Crédit ", F.col("credit_id"), " : ", F.col("montant_initial"), " EUR sur ",
                     F.col("duree_mois"), " mois, taux ", F.col("taux_annuel"), ".").alias("message"),
    )


# ======================================================== filters and predicates
@register("f1_f4_missing_domain_range", f"""select agence_id,
 (nom_agence is null or ville is null or code_postal is null or region is null or categorie_agence is null) as incomplete,
 (categorie_agence is null or categorie_agence not in {O.inlist(O.CATEGORIES)}) as hors_domaine,
 (effectif is null or effectif not between 1 and 20) as hors_bornes,
 (concat_ws('', nom_agence, ville, departement, region, categorie_agence) like '%├%'
  or concat_ws('', nom_agence, ville, departement, region, categorie_agence) like '%√%'
  or concat_ws('', nom_agence, ville, departement, region, categorie_agence) like '%Ã%') as encodage from stg_agences""")
def _(x: Context) -> DataFrame:
    return x.staging["agences"].select(
        "agence_id",
        P.any_null("nom_agence", "ville", "code_postal", "region", "categorie_agence").alias("incomplete"),
        P.outside_domain(F.col("categorie_agence"), domains.CATEGORIE_AGENCE).alias("hors_domaine"),
        P.outside_range(F.col("effectif"), 1, 20).alias("hors_bornes"),
        P.mojibake("nom_agence", "ville", "departement", "region", "categorie_agence").alias("encodage"),
    )


@register("f5_f7_shapes", """select client_id,
 (client_id is null or not regexp_full_match(client_id, 'C[0-9]{6}')) as code_faux,
 coalesce(length(rtrim(code_postal)) <> 5 or regexp_matches(code_postal, '[^0-9]'), false) as code_postal_faux,
 coalesce(email not like '%@%.%' or email like '% %', false) as email_faux from stg_clients""")
def _(x: Context) -> DataFrame:
    return x.staging["clients"].select(
        "client_id",
        P.wrong_code(F.col("client_id"), "C", 6).alias("code_faux"),
        P.wrong_postcode(F.col("code_postal")).alias("code_postal_faux"),
        P.wrong_email(F.col("email")).alias("email_faux"),
    )


@register("f8_f9_sign_and_future", """select transaction_id,
 coalesce((sens = 'Débit' and montant >= 0) or (sens = 'Crédit' and montant <= 0), false) as signe_incoherent,
 coalesce(cast(date_transaction as date) > date '2023-06-30', false) as apres_reference from stg_transactions""")
def _(x: Context) -> DataFrame:
    side, value = F.col("sens"), F.col("montant")
    wrong = ((side == "Débit") & (value >= 0)) | ((side == "Crédit") & (value <= 0))
    return x.staging["transactions"].select(
        "transaction_id",
        P.any_of(wrong).alias("signe_incoherent"),
        P.after(F.col("date_transaction").cast("date"), "2023-06-30").alias("apres_reference"),
    )


@register("f10_f12_conversion_and_difference", f"""select ligne_source,
 ({O.b2n('montant')} is not null and {O.sdec('montant', 15, 2)} is null) as montant_illisible,
 ({O.b2n('date_transaction')} is not null and {O.sts('date_transaction')} is null) as date_illisible,
 coalesce({O.clean('statut')} <> {O.canon(O.clean('statut'), O.STATUTS_TRANS, {'VALIDEE': 'Validée', 'REJETEE': 'Rejetée'})}, false) as statut_change,
 coalesce(produit_id, '') <> coalesce(upper({O.b2n('produit_id')}), '') as produit_change from raw_transactions""")
def _(x: Context) -> DataFrame:
    label = text.clean_text(F.col("statut"))
    spellings = domains.spelling_map(domains.STATUT_TRANSACTION, domains.UNACCENTED_STATUT_TRANSACTION)
    return x.raw["transactions"].select(
        "ligne_source",
        P.failed_conversion(F.col("montant"), parsing.safe_decimal(F.col("montant"), 15, 2)).alias("montant_illisible"),
        P.failed_conversion(F.col("date_transaction"), parsing.safe_timestamp(F.col("date_transaction"))).alias("date_illisible"),
        P.differs(label, text.canonical(label, spellings)).alias("statut_change"),
        P.differs_or_missing(F.col("produit_id"), text.reference_key(F.col("produit_id"))).alias("produit_change"),
    )


# ======================================================================== joins
@register("j1_raw_to_staging", f"""select s.client_id, r.revenu_mensuel as revenu_avant, s.revenu_mensuel as revenu_apres
 from raw_clients r join stg_clients s on upper({O.b2n('r.client_id')}) = upper(s.client_id)""")
def _(x: Context) -> DataFrame:
    before = x.raw["clients"].select(
        text.reference_key(F.col("client_id")).alias("k"), F.col("revenu_mensuel").alias("revenu_avant")
    )
    after = x.staging["clients"].select("client_id", F.col("revenu_mensuel").alias("revenu_apres"))
    return before.join(after, F.col("k") == F.upper("client_id")).select("client_id", "revenu_avant", "revenu_apres")


_TARGETS = ("objectif_revenu", "objectif_nouveaux_clients", "objectif_production_credit", "seuil_taux_impaye_pct")


@register("j2_composite_key", "select s.agence_id, s.mois, "
          + ", ".join(f"r.{v} as {v}_texte, s.{v}" for v in _TARGETS)
          + f" from raw_objectifs_agences r join stg_objectifs_agences s on {O.b2n('r.agence_id')} = s.agence_id"
            f" and {O.smonth('r.mois')} = s.mois")
def _(x: Context) -> DataFrame:
    return quality.target_pairs(x.raw, x.staging)


@register("j5_dense_keys", "select client_key, client_id from dim_client")
def _(x: Context) -> DataFrame:
    return dimensions.dim_client(x.staging).select("client_key", "client_id")


@register("j6_date_lookup", """select cast(coalesce(d.date_key, 0) as integer) as date_key, cast(count(*) as bigint) as nombre
 from stg_transactions t left join dim_date d on d.date_complete = cast(t.date_transaction as date) group by 1""")
def _(x: Context) -> DataFrame:
    keyed = lookup.resolve_key(
        x.staging["transactions"].select("date_transaction"), F.col("date_transaction").cast("date"),
        x.dims["dim_date"], "date_complete", "date_key", "date_key", broadcast=True,
    )
    return keyed.groupBy("date_key").agg(F.count(F.lit(1)).alias("nombre"))


@register("j7_credit_bridge", """select cr.credit_id, coalesce(c.client_key, 0) as client_key, coalesce(a.agence_key, 0) as agence_key,
 cr.type_credit, cr.statut_credit from stg_credits cr
 left join dim_client c on c.client_id = cr.client_id and c.client_key <> 0
 left join dim_agence a on a.agence_id = cr.agence_id and a.agence_key <> 0""")
def _(x: Context) -> DataFrame:
    return facts.credit_bridge(x.staging, x.dims).withColumnRenamed("_credit", "credit_id")


@register("j8_null_orphans", """select credit_id, client_id, agence_id from stg_credits""")
def _(x: Context) -> DataFrame:
    typed = dedup.first_by(
        staging.typed_credits(x.raw), F.col("credit_id"), [F.col("ligne_source")]
    ).select("credit_id", "client_id", "agence_id")
    return lookup.null_orphans(
        typed,
        {"client_id": (x.raw["clients"], "client_id"), "agence_id": (x.raw["agences"], "agence_id")},
        large={"client_id": lookup.hot_keys(typed, F.upper("client_id"), min_rows=20)},
        spread_by=["credit_id"],
    ).select("credit_id", "client_id", "agence_id")


@register("j9_orphan_rows", f"""select transaction_id, produit_id from raw_transactions where {O.b2n('produit_id')} is not null
 and upper({O.b2n('produit_id')}) not in {O._refs('produits', 'produit_id')}""")
def _(x: Context) -> DataFrame:
    return lookup.orphan_rows(x.raw["transactions"], "produit_id", x.raw["produits"], "produit_id").select(
        "transaction_id", "produit_id"
    )


@register("j10_any_orphan", """select cast(count(*) as bigint) as lignes_cassees from fact_transactions f
 where f.date_key not in (select date_key from dim_date where est_weekend is not true)
 or f.agence_key not in (select agence_key from dim_agence where categorie_agence <> 'Rurale')""")
def _(x: Context) -> DataFrame:
    """Two narrowed dimensions, so that rows break on one key, the other, or both."""
    weekdays = x.dims["dim_date"].where("est_weekend is not true")
    towns = x.dims["dim_agence"].where("categorie_agence <> 'Rurale'")
    return lookup.any_orphan(
        x.facts["fact_transactions"],
        [("date_key", weekdays, "date_key"), ("agence_key", towns, "agence_key")],
        "lignes_cassees",
    )


@register("j11_credit_without_branch", """select cast(count(*) as bigint) as agences_credit_inconnues from stg_remboursements r
 join stg_credits cr on cr.credit_id = r.credit_id left join dim_agence a on a.agence_id = cr.agence_id and a.agence_key <> 0
 where a.agence_key is null""")
def _(x: Context) -> DataFrame:
    return controls.repayment_unknowns(x.staging, x.dims).select("agences_credit_inconnues")


# ================================================================= aggregations
@register("g1_g5_global_aggregates", """select cast(count(*) as bigint) as lignes, cast(count(distinct client_id) as bigint) as clients,
 cast(coalesce(sum(montant), 0) as decimal(38,2)) as montant_total, cast(count(*) filter (where frais > 0) as bigint) as avec_frais,
 min(montant) as montant_min, max(montant) as montant_max, min(date_transaction) as premiere, max(date_transaction) as derniere
 from stg_transactions""")
def _(x: Context) -> DataFrame:
    return x.staging["transactions"].agg(
        F.count(F.lit(1)).alias("lignes"),
        F.countDistinct("client_id").alias("clients"),
        F.coalesce(F.sum("montant"), F.lit(0)).cast("decimal(38,2)").alias("montant_total"),
        F.count_if(F.col("frais") > 0).alias("avec_frais"),
        F.min("montant").alias("montant_min"),
        F.max("montant").alias("montant_max"),
        F.min("date_transaction").alias("premiere"),
        F.max("date_transaction").alias("derniere"),
    )


@register("g7_g8_grouped_counts", """select type_credit, statut_credit, cast(count(*) as bigint) as nombre_credits
 from stg_credits group by 1, 2""")
def _(x: Context) -> DataFrame:
    return quality.distribution(x.staging["credits"], "type_credit", "statut_credit", count="nombre_credits")


@register("g9_grouped_sums", """select type_transaction, cast(count(*) as bigint) as nombre_transactions,
 cast(sum(montant) as decimal(38,2)) as montant_total, cast(sum(frais) as decimal(38,2)) as frais_totaux
 from stg_transactions group by 1""")
def _(x: Context) -> DataFrame:
    return quality.distribution(
        x.staging["transactions"], "type_transaction", count="nombre_transactions",
        montant_total="montant", frais_totaux="frais",
    )


@register("g10_group_by_expression", """select cast(year(mois) as integer) as annee, cast(count(*) as bigint) as nombre_lignes,
 cast(count(distinct agence_id) as bigint) as nombre_agences, cast(count(distinct mois) as bigint) as nombre_mois
 from stg_objectifs_agences group by 1""")
def _(x: Context) -> DataFrame:
    return quality.targets_by_year(x.staging)


def _dup_sql(source: str, key: str) -> str:
    return f"(select {key} as k, count(*) as n from {source} where {key} is not null group by 1 having count(*) > 1)"


@register("g11_duplicate_keys", f"select k as transaction_id, cast(n as bigint) as nombre_occurrences from {_dup_sql('raw_transactions', O.b2n('transaction_id'))} d")
def _(x: Context) -> DataFrame:
    return grouping.duplicates(
        x.raw["transactions"], {"transaction_id": text.blank_to_null(F.col("transaction_id"))}
    )


@register("g12_key_precondition", """select client_id, produit_id, cast(count(*) as bigint) as nombre_occurrences
 from stg_transactions group by 1, 2 having client_id is null or produit_id is null or count(*) > 1""")
def _(x: Context) -> DataFrame:
    return grouping.broken_keys(x.staging["transactions"], ["client_id", "produit_id"])


@register("g13_coverage_gaps", """select agence_id, cast(count(distinct mois) as bigint) as nombre_mois_disponibles,
 (select cast(count(distinct mois) as bigint) from stg_objectifs_agences) as nombre_mois_attendus from stg_objectifs_agences
 where agence_id is not null and mois is not null group by 1
 having count(distinct mois) <> (select count(distinct mois) from stg_objectifs_agences)""")
def _(x: Context) -> DataFrame:
    return quality.branch_gaps(x.staging)


# ======================================================== windows, order and sets
_LINES = """(select case when event_id % 3 <> 0 then cast(event_id // 4 as varchar) end as id,
 case when event_id % 6 <> 0 then event_id end as ligne_source, event_type from events)"""


def _event_lines(x: Context) -> DataFrame:
    """All events as source lines: a third without identifier, half of those without line number."""
    k = F.col("event_id")
    return x.spark.read.parquet(f"{x.sf_dir}/events.parquet").select(
        F.when(k % 3 != 0, F.floor(k / 4).cast("string")).alias("id"),
        F.when(k % 6 != 0, k).alias("ligne_source"),
        "event_type",
    )


@register("w1_first_occurrence", f"""select id, ligne_source, event_type from (select *, row_number() over (
 partition by id, case when id is null then coalesce(ligne_source, -1) end
 order by ligne_source nulls first, event_type nulls first) as rang from {_LINES} l) t where rang = 1""")
def _(x: Context) -> DataFrame:
    """Identifiers shared by several lines; without identifier every numbered line stays, and one of those without number."""
    lines = _event_lines(x)
    key = dedup.occurrence_key(F.col("id"), F.col("ligne_source"))
    return dedup.first_by(lines, key, [F.col("ligne_source"), F.col("event_type")])


@register("w1_lines_without_identifier", f"""select id is null as sans_identifiant, count(*) as lignes, count(distinct ligne_source) as numeros,
 count(distinct coalesce(id, 'SANS_ID_' || coalesce(cast(ligne_source as varchar), ''))) as groupes from {_LINES} l group by 1""")
def _(x: Context) -> DataFrame:
    """How many groups the lines fall into, with and without identifier."""
    key = dedup.occurrence_key(F.col("id"), F.col("ligne_source")).alias("cle")
    per_group = _event_lines(x).groupBy(F.col("id").isNull().alias("sans_identifiant"), key).agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("ligne_source").alias("numeros")
    )
    return per_group.groupBy("sans_identifiant").agg(
        F.sum("n").alias("lignes"), F.sum("numeros").alias("numeros"), F.count(F.lit(1)).alias("groupes")
    )


@register("w2_first_raw_line", f"""select k as client_id, ligne_source, email from (select upper({O.b2n('client_id')}) as k, ligne_source, email,
 row_number() over (partition by upper({O.b2n('client_id')}) order by {O.sint('ligne_source')} nulls first) as r from raw_clients) t where r = 1""")
def _(x: Context) -> DataFrame:
    keyed = x.raw["clients"].withColumn("k", text.reference_key(F.col("client_id")))
    first = dedup.first_by(keyed, F.col("k"), [parsing.safe_int(F.col("ligne_source")), F.col("email")])
    return first.select(F.col("k").alias("client_id"), "ligne_source", "email")


_PRODUCTION = """(select mois_debut, cast(sum(montant_initial) as decimal(38,2)) as production_credit
 from fact_credits f join dim_date d on d.date_key = f.{fk} where mois_debut is not null group by 1)"""


@register("w3_prior_year", f"""select a.mois_debut, a.production_credit, b.production_credit as production_credit_annee_precedente,
 cast(a.production_credit - b.production_credit as decimal(38,2)) as evolution_production_credit,
 cast(cast(a.production_credit as decimal(18,2)) - cast(b.production_credit as decimal(18,2)) as double)
  / nullif(cast(b.production_credit as double), 0) as evolution_production_credit_pct
 from {_PRODUCTION.format(fk='date_octroi_key')} a
 left join {_PRODUCTION.format(fk='date_octroi_key')} b on a.mois_debut = cast(b.mois_debut + interval 12 month as date)""")
def _(x: Context) -> DataFrame:
    monthly = M.measure(x.mart, M.CREDITS, ["production_credit"], ["mois_debut"]).where("mois_debut is not null")
    out = M.prior_year(monthly, "production_credit")
    return out.withColumn(
        "evolution_production_credit", F.col("evolution_production_credit").cast("decimal(38,2)")
    )


@register("w4_alternate_date_role", f"select mois_debut, production_credit from {_PRODUCTION.format(fk='date_fin_prevue_key')} t")
def _(x: Context) -> DataFrame:
    by_end = M.measure(x.mart, M.CREDITS, ["production_credit"], ["mois_debut"], date_role="fin_prevue")
    return by_end.where("mois_debut is not null")


@register("o2_top_n", """select transaction_id, montant from stg_transactions order by montant desc nulls last, transaction_id limit 40""")
def _(x: Context) -> DataFrame:
    return grouping.top(
        x.staging["transactions"].select("transaction_id", "montant"), 40, F.desc_nulls_last("montant"), "transaction_id"
    )


@register("s1_date_bounds", "select date_min, date_max from date_bounds")
def _(x: Context) -> DataFrame:
    return calendar.date_bounds(x.staging)


@register("s3_calendar_days", "select date_complete from dim_date where date_key <> 0")
def _(x: Context) -> DataFrame:
    return calendar.days(calendar.date_bounds(x.staging))


# --- scalar functions not covered elsewhere
@register("s7_date_functions", """select credit_id, cast((year(date_fin_prevue) - year(date_octroi)) * 12 + month(date_fin_prevue)
 - month(date_octroi) as integer) as mois_ecoules, cast(date_octroi + to_months(duree_mois) as date) as fin_calculee,
 cast(date_diff('day', date_octroi, date_fin_prevue) as integer) as jours, strftime(date_octroi, '%d/%m/%Y') as octroi_fr,
 cast(isodow(date_octroi) as integer) as jour_semaine from stg_credits""")
def _(x: Context) -> DataFrame:
    first, last = F.col("date_octroi"), F.col("date_fin_prevue")
    return x.staging["credits"].select(
        "credit_id",
        dates.month_boundaries(first, last).alias("mois_ecoules"),
        F.add_months(first, F.col("duree_mois")).alias("fin_calculee"),
        F.datediff(last, first).alias("jours"),
        dates.french_date(first).alias("octroi_fr"),
        dates.weekday_number(first).alias("jour_semaine"),
    )


# ================================================================= staging jobs
for _n, (_t, _job) in enumerate(staging.JOBS.items(), 1):
    register(f"p{_n}_stage_{_t}", _select(f"stg_{_t}"))(lambda x, job=_job: job(x.raw))

# ========================================================== dimensions and facts
register("d1_dim_date", _select("dim_date"))(lambda x: calendar.dim_date(calendar.date_bounds(x.staging)))
register("d2_dim_agence", _select("dim_agence"))(lambda x: dimensions.dim_agence(x.staging))
register("d3_dim_client", _select("dim_client"))(lambda x: dimensions.dim_client(x.staging))
register("d4_dim_produit", _select("dim_produit"))(lambda x: dimensions.dim_produit(x.staging))
for _n, (_t, _job) in enumerate(facts.JOBS.items(), 1):
    register(f"k{_n}_{_t}", _select(_t))(lambda x, job=_job: job(x.staging, x.dims))


def _guard_sql(conditions: dict[str, str]) -> str:
    return " union all ".join(
        f"select '{name}' as garde, cast(({sql}) as bigint) as anomalies" for name, sql in conditions.items()
    )


_UNKNOWN = {
    f"{d}: membre inconnu présent": f"select case when count(*) > 0 then 0 else 1 end from {d} where {k} = 0"
    for d, k in guards.DIMENSION_KEYS.items()
}


@register("d5_dimension_guards", _guard_sql(
    {f"{d}: lignes = staging + 1": f"select abs((select count(*) from {d}) - (select count(*) from stg_{s}) - 1)"
     for d, s in guards.DIMENSION_SOURCES.items()}
    | {"dim_date: jours = étendue": "select abs(date_diff('day', date_min, date_max) + 1 - (select count(*) from dim_date"
                                    " where date_key <> 0)) from date_bounds"}
    | _UNKNOWN))
def _(x: Context) -> DataFrame:
    return guards.dimension_guards(x.staging, x.dims)


@register("k6_fact_preconditions", _guard_sql(
    {f"{t}: clé métier unique": f"select count(*) from (select {', '.join(keys)} from stg_{t} group by {', '.join(keys)} having "
                                f"{' or '.join(k + ' is null' for k in keys)} or count(*) > 1) q"
     for t, keys in guards.FACT_KEYS.items()} | _UNKNOWN))
def _(x: Context) -> DataFrame:
    return guards.fact_preconditions(x.staging, x.dims)


@register("k7_fact_guards", _guard_sql(
    {f"{f}: lignes = staging": f"select abs((select count(*) from {f}) - (select count(*) from stg_{s}))"
     for f, s in guards.FACT_SOURCES.items()}))
def _(x: Context) -> DataFrame:
    return guards.fact_guards(x.staging, x.facts)
