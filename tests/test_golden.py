"""The planted bank: documented counts, star invariants, controls and rebuilds."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerflow.plans import calendar, controls, facts, guards, quality, staging, summaries, warehouse
from ledgerflow.sources import publish
from ledgerflow.sources.schemas import RAW_COLUMNS

AS_OF = "2026-06-30"


@pytest.fixture(scope="module")
def counted(golden):
    report = quality.full_report(golden.raw, golden.staging, AS_OF).collect()
    return {(r.nom_table, r.controle): r.valeur for r in report}


def test_row_counts(golden):
    rows = {r.nom_table: (r.lignes_raw, r.lignes_staging, r.statut) for r in quality.row_counts(golden.raw, golden.staging).collect()}
    assert rows == {
        "agences": (25, 25, "OK"),
        "clients": (6060, 6000, "OK"),
        "credits": (600, 600, "OK"),
        "objectifs_agences": (1050, 1050, "OK"),
        "produits": (10, 10, "OK"),
        "remboursements": (18899, 18899, "OK"),
        "transactions": (15150, 15000, "OK"),
    }


@pytest.mark.parametrize(
    "table, check, wanted",
    [
        ("raw-staging.agences", "lignes_modifiees", 15),
        ("raw.clients", "lignes_en_trop", 60),
        ("raw.clients", "revenus_negatifs_source", 7),
        ("staging.clients", "revenus_manquants_ou_invalides", 7),
        ("staging.clients", "codes_postaux_manquants", 25),
        ("staging.clients", "emails_manquants", 30),
        ("raw.credits", "taux_negatifs_source", 15),
        ("staging.credits", "taux_remplaces_par_null", 15),
        ("raw-staging.credits", "remplaces_par_null", 15),
        ("raw.credits", "agence_id_orphelins", 10),
        ("staging.credits", "agences_remplacees_par_null", 10),
        ("raw-staging.credits", "type_credit_modifies", 20),
        ("raw-staging.credits", "statut_credit_modifies", 25),
        ("raw.remboursements", "paiements_negatifs_source", 20),
        ("raw-staging.remboursements", "remplaces_par_null", 20),
        ("raw.remboursements", "credit_id_orphelins", 25),
        ("raw.remboursements", "dates_paiement_absentes", 103),
        ("raw.remboursements", "statuts_non_standardises_source", 40),
        ("raw-staging.remboursements", "statut_remboursement_modifies", 40),
        ("staging.remboursements", "nombre_impayes", 103),
        ("staging.remboursements", "impayes_incoherents", 0),
        ("staging.remboursements", "retards_calcules_incoherents", 0),
        ("raw.transactions", "lignes_en_trop", 150),
        ("raw.transactions", "conversions_impossibles: date_transaction", 40),
        ("staging.transactions", "dates_nulles_staging", 40),
        ("raw.transactions", "produits_absents_source", 154),
        ("staging.transactions", "produits_absents_staging", 150),
        ("raw.transactions", "agence_id_orphelins", 60),
        ("staging.transactions", "agences_remplacees_par_null", 60),
        ("raw-staging.transactions", "sens_modifies", 250),
        ("raw-staging.transactions", "statut_modifies", 150),
        ("staging.transactions", "nombre_debits", 11695),
        ("staging.transactions", "nombre_credits", 3305),
        ("staging.transactions", "operations_avec_frais", 782),
        ("staging.transactions", "lignes_en_trop", 0),
    ],
)
def test_planted_anomalies(counted, table, check, wanted):
    assert counted[table, check] == wanted


def test_clean_checks_stay_clean(golden):
    report = quality.counted(golden.raw, golden.staging, AS_OF, ("Q5", "Q6", "Q8", "Q9", "Q13", "Q15", "Q16"))
    assert report.where("statut = 'ATTENTION'").collect() == []


def test_payment_split(golden):
    r = quality.payment_split(golden.staging).first()
    assert (r.paiements_complets, r.paiements_partiels, r.echeances_impayees, r.montants_invalides_null) == (18655, 121, 103, 20)
    assert (r.total_echeances, r.statut) == (18899, "OK")


def test_distributions(golden):
    found = {(r.colonne, r.valeur): r.nombre for r in quality.label_distributions(golden.staging).collect()}
    assert found["statut_remboursement", "Payé à temps"] == 11514
    assert found["statut_remboursement", "Payé en retard"] == 7282
    assert found["statut", "Validée"] == 14524 and found["statut", "Rejetée"] == 371 and found["statut", "En attente"] == 105
    types = quality.distribution(golden.staging["transactions"], "type_transaction").collect()
    assert sorted(r.nombre for r in types) == [608, 782, 910, 1033, 1477, 1787, 2626, 5777]


def test_target_grid(golden):
    r = quality.grid(golden.staging).first()
    assert (r.agences_distinctes, r.mois_distincts, r.lignes_reelles, r.statut) == (25, 42, 1050, "OK")
    m = quality.month_continuity(golden.staging).first()
    assert (m.premier_mois, m.dernier_mois, m.statut) == (dt.date(2023, 1, 1), dt.date(2026, 6, 1), "OK")


def test_all_controls_hold(golden):
    rows = controls.controls(golden.staging, golden.mart).orderBy("controle_id").collect()
    assert [r.controle for r in rows if r.statut != "OK"] == []
    per_category = {}
    for r in rows:
        per_category[r.categorie] = per_category.get(r.categorie, 0) + 1
    assert per_category == {
        "Préparation": 1, "Dimensions": 11, "Tables de faits": 5, "Grains": 5, "Clés inconnues": 17,
        "Montants": 6, "Indicateurs": 10, "Relations": 6,
    }
    branch = next(r for r in rows if r.controle == "Agences inconnues dans fact_remboursements")
    assert branch.valeur_observee == 308
    assert "25 sans crédit, 283 dont le crédit" in branch.commentaire
    verdict = controls.verdict(controls.controls(golden.staging, golden.mart), golden.mart).first()
    assert (verdict.controles_ok, verdict.controles_attention) == (61, 0)


def test_controls_see_planted_damage(golden):
    """Broken keys, a lost row and a changed amount each show up."""
    f = golden.mart["fact_transactions"]
    damaged = f.where("transaction_id <> 'T000000777'").withColumn(
        "agence_key", F.when(F.col("transaction_id") == "T000000500", 9999).otherwise(F.col("agence_key"))
    ).withColumn(
        "client_key",
        F.when(F.col("transaction_id").isin("T000000500", "T000000501"), -5).otherwise(F.col("client_key")),
    ).withColumn(
        "montant_debit", F.when(F.col("transaction_id") == "T000000502", 1).otherwise(F.col("montant_debit"))
    )
    mart = golden.mart | {"fact_transactions": damaged}
    wrong = {r.controle: r.ecart for r in controls.controls(golden.staging, mart).where("statut <> 'OK'").collect()}
    assert wrong["Nombre de transactions"] == -1
    assert wrong["Clés orphelines dans fact_transactions"] == 2
    assert wrong["Relations vérifiées"] == -2
    assert wrong["Cohérence de montant_debit"] == 1
    assert "Montant signé total des transactions" in wrong


def test_unknown_branch_causes(golden):
    rows = summaries.unknown_branch_causes(golden.staging, golden.dims).collect()
    assert {r.cause_agence_inconnue: r.nombre_echeances for r in rows} == {
        "Crédit introuvable": 25, "Agence du crédit inconnue": 283,
    }


def test_guards_refuse_a_broken_build(golden):
    twice = golden.staging | {"credits": golden.staging["credits"].unionByName(golden.staging["credits"])}
    with pytest.raises(guards.GuardFailed, match="credits: clé métier unique .600."):
        guards.enforce(guards.fact_preconditions(twice, golden.dims))
    no_member = golden.dims | {"dim_client": golden.dims["dim_client"].where("client_key <> 0")}
    with pytest.raises(guards.GuardFailed, match="dim_client: membre inconnu présent"):
        guards.enforce(guards.dimension_guards(golden.staging, no_member))


def _content(tables):
    return {n: sorted(map(str, df.collect())) for n, df in tables.items()}


def test_rebuild_is_identical_with_other_partitioning(golden, spark):
    """Same rows and same keys from one lazy plan, whatever the number of shuffle partitions."""
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        again = staging.stage_credits(golden.raw)
        refact = facts.fact_remboursements(golden.staging, golden.dims)
        published = golden.mart["fact_remboursements"].drop(facts.MONTH)
        assert _content({"c": again, "f": refact}) == _content({"c": golden.staging["credits"], "f": published})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_published_warehouse_can_be_loaded(spark, golden, tmp_path):
    root = str(tmp_path / "w")
    built = warehouse.build(spark, golden.raw, root)
    loaded = warehouse.load(spark, root)
    assert set(loaded.mart) == set(built.mart) == set(golden.mart)
    assert _content({"a": loaded.mart["dim_agence"]}) == _content({"a": golden.mart["dim_agence"]})


def test_layers_are_queryable_by_name(spark, golden, tmp_path):
    root = str(tmp_path / "w")
    publish.publish(spark, f"{root}/raw", {"produits": golden.raw["produits"]})
    publish.publish(spark, f"{root}/staging", {"produits": golden.staging["produits"]})
    mart = {name: golden.mart[name] for name in ("dim_agence", "fact_credits")}
    publish.publish(spark, f"{root}/mart", mart)
    for _ in range(2):
        assert set(warehouse.register(spark, root, "g_")) == {
            "g_raw.produits", "g_staging.produits", "g_mart.dim_agence", "g_mart.fact_credits",
        }
    rows = spark.sql(
        "select a.agence_id, sum(f.nombre_credits) as n from g_mart.fact_credits f"
        " join g_mart.dim_agence a on a.agence_key = f.agence_key group by 1"
    ).collect()
    assert {r.agence_id: r.n for r in rows}["INCONNUE"] == 10


def test_calendar_rows(spark):
    bounds = spark.sql("select date'2020-12-28' as date_min, date'2024-01-07' as date_max")
    days = {r.date_key: r for r in calendar.dim_date(bounds).collect()}
    monday = days[20240101]
    assert (monday.jour_semaine_numero, monday.nom_jour, monday.trimestre_libelle, monday.semestre_numero, monday.semaine_iso) == (
        1, "Lundi", "T1", 1, 1)
    assert days[20210101].semaine_iso == 53
    assert days[20240106].est_weekend and days[20240107].est_weekend and not days[20240105].est_weekend
    assert (days[0].date_complete, days[0].nom_jour, days[0].libelle_date) == (None, "Inconnu", "Date inconnue")
    assert days[20230815].nom_mois == "Août" and days[20230815].libelle_date == "15/08/2023"


def test_calendar_without_any_date(spark):
    bounds = spark.sql("select cast(null as date) as date_min, cast(null as date) as date_max")
    r = calendar.days(bounds).agg(F.min("date_complete"), F.max("date_complete"), F.count("*")).first()
    assert tuple(r) == (dt.date(2021, 1, 1), dt.date(2026, 12, 31), 2191)


def test_failed_fact_guard_keeps_the_whole_mart(spark, golden, tmp_path):
    """A delivery with a new first branch and a repeated instalment: old facts stay on old keys."""
    root = str(tmp_path / "w")
    warehouse.build(spark, golden.raw, root)
    per_branch = lambda mart: {
        r.agence_id: r.n
        for r in mart["fact_credits"].join(mart["dim_agence"], "agence_key").groupBy("agence_id").agg(F.sum("nombre_credits").alias("n")).collect()
    }
    before = per_branch(warehouse.load(spark, root).mart)
    stg = dict(golden.staging)
    stg["agences"] = stg["agences"].unionByName(stg["agences"].limit(1).withColumn("agence_id", F.lit("A000")))
    stg["remboursements"] = stg["remboursements"].unionByName(stg["remboursements"].limit(1))
    with pytest.raises(guards.GuardFailed):
        warehouse.build_mart(spark, stg, root)
    assert per_branch(warehouse.load(spark, root).mart) == before


def test_lower_case_identifiers_find_their_members(spark, golden):
    stg = dict(golden.staging)
    stg["credits"] = stg["credits"].withColumn("client_id", F.lower("client_id")).withColumn("agence_id", F.lower("agence_id"))
    known = lambda df: df.where("client_key <> 0 and agence_key <> 0").count()
    assert known(facts.fact_credits(stg, golden.dims)) == known(golden.mart["fact_credits"]) > 0


def test_raw_offenders_are_listed_whole(spark):
    """Rows as received behind the counted checks of missing values and formats."""
    columns = ", ".join(f"{c} string" for c in RAW_COLUMNS["credits"])
    good = [f"v{i}" for i in range(len(RAW_COLUMNS["credits"]))]
    rows = [good, [*good[:3], " ", *good[4:]], [good[0], None, *good[2:]], good]
    raw = {"credits": spark.createDataFrame([tuple(r) for r in rows], columns)}
    listed = quality.raw_offenders(raw, "credits", "lignes_source_incompletes", []).collect()
    assert sorted(map(str, map(tuple, listed))) == sorted(map(str, map(tuple, rows[1:3])))
    codes = ["R00000001", " r00000002 ", "R1", None, "X00000001"]
    paid = {c: F.lit("x").alias(c) for c in RAW_COLUMNS["remboursements"] if c != "remboursement_id"}
    frame = spark.createDataFrame([(c,) for c in codes], "remboursement_id string").select("remboursement_id", *paid.values())
    wrong = quality.raw_offenders({"remboursements": frame}, "remboursements", "remboursement_id_invalides", [])
    assert {r.remboursement_id for r in wrong.collect()} == {"R1", None, "X00000001"}


def test_orphans_before_and_after(golden):
    rows = quality.orphan_changes(golden.raw, golden.staging, "credits", "agence_id", "credit_id").collect()
    assert len(rows) == 10 and all(r.agence_id_avant and r.agence_id_apres is None for r in rows)


def test_verdict_reads_no_table_for_its_volumes(golden):
    """All volumes come from the manifest; a plain dictionary of tables is counted."""
    results = golden.mart["dim_agence"].sparkSession.createDataFrame([("OK",)], "statut string")
    plan = controls.verdict(results, golden.mart)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan
    by_manifest, by_reading = (controls.verdict(results, m).first() for m in (golden.mart, dict(golden.mart)))
    assert by_manifest == by_reading and by_manifest.transactions == 15000 and by_manifest.agences_reelles == 25
    for guard in (guards.fact_guards(golden.staging, golden.facts), guards.unknown_members(golden.dims)):
        assert "FileScan" not in guard._jdf.queryExecution().executedPlan().toString()
