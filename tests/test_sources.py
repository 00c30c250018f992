"""CSV dialect, catalog layers, guards and atomic publication."""

import pytest
from pyspark.sql import functions as F

from ledgerflow.plans.guards import GuardFailed
from ledgerflow.sources import layers, publish
from ledgerflow.sources.files import Files
from ledgerflow.sources.schemas import RAW_COLUMNS
from ledgerflow.sources.text_files import read_raw_csv, write_raw_csv


def test_csv_values_are_kept_as_written(spark, tmp_path):
    path = tmp_path / "produits.csv"
    path.write_text(
        "produit_id,nom_produit,famille_produit,univers,niveau_complexite\n"
        'P001," Livret, ""vert"" ",├ëpargne,Épargne et flux,01\n'
        "P002,,Carte,Moyens de paiement,\n",
        encoding="utf-8",
    )
    rows = read_raw_csv(spark, "produits", str(path)).orderBy("produit_id").collect()
    assert tuple(rows[0]) == ("P001", ' Livret, "vert" ', "├ëpargne", "Épargne et flux", "01")
    assert rows[1].nom_produit is None and rows[1].niveau_complexite is None
    assert rows[0].__fields__ == list(RAW_COLUMNS["produits"])


def test_csv_round_trip(spark, tmp_path):
    rows = [("P1", ' a "b", c ', "é", "x", "1"), ("P2", "plain", "y", "z", "2")]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in RAW_COLUMNS["produits"]))
    write_raw_csv(df, str(tmp_path / "out"))
    write_raw_csv(df, str(tmp_path / "out"))
    assert sorted(map(tuple, read_raw_csv(spark, "produits", str(tmp_path / "out")).collect())) == rows


def test_failed_verification_keeps_the_previous_version(spark, tmp_path):
    root = str(tmp_path / "layer")
    publish.publish(spark, root, {"t": spark.range(3)})

    def refuse(tables):
        raise GuardFailed(f"{tables['t'].count()} rows")

    with pytest.raises(GuardFailed, match="9 rows"):
        publish.publish(spark, root, {"t": spark.range(9)}, verify=refuse)
    assert publish.read_published(spark, root)["t"].count() == 3
    publish.publish(spark, root, {"t": lambda: spark.range(5)})
    assert publish.current_version(spark, root)[0] == 2
    assert publish.read_published(spark, root)["t"].count() == 5


def test_nothing_published(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        publish.read_published(spark, str(tmp_path / "none"))


def test_partitioned_publication_prunes(spark, tmp_path):
    df = spark.range(100).selectExpr("id", "id % 4 as annee_mois")
    out = publish.publish(spark, str(tmp_path / "p"), {"f": df}, partition_by={"f": ["annee_mois"]})
    plan = out["f"].where("annee_mois = 2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(annee_mois" in plan


def test_layers_and_guard(spark):
    names = layers.create_layers(spark, "t_")
    assert names == layers.create_layers(spark, "t_")
    layers.replace_table(spark.range(4), "t_staging.x")
    layers.replace_table(spark.range(2).selectExpr("id", "id as b"), "t_staging.x")
    assert spark.table("t_staging.x").count() == 2
    report = layers.catalog_column_report(spark, "t_staging").collect()
    assert [(r.nom_table, r.nombre_colonnes) for r in report] == [("x", 2)]
    layers.require_tables(spark, [("t_staging.x", "staging")])
    with pytest.raises(layers.MissingTables, match="t_mart.y .created by facts."):
        layers.require_tables(spark, [("t_staging.x", "staging"), ("t_mart.y", "facts")])


def test_volume_report_and_preview(spark):
    report = layers.volume_report({"a": spark.range(3), "b": spark.range(0)}).collect()
    assert sorted(map(tuple, report)) == [("a", 3), ("b", 0)]
    assert [r.id for r in layers.preview(spark.range(100).repartition(3), 4, "id").collect()] == [0, 1, 2, 3]


def test_entry_point_builds_from_extracts(spark, golden, tmp_path, capsys):
    """Extract files in, published warehouse and verdict out."""
    from ledgerflow import run
    from ledgerflow.sources.text_files import EXTRACT_FILES

    for table, name in EXTRACT_FILES.items():
        write_raw_csv(golden.raw[table], str(tmp_path / "in" / name))
    run.main(["--extracts", str(tmp_path / "in"), "--root", str(tmp_path / "out")])
    printed = capsys.readouterr().out
    assert "Modèle validé : 61 contrôles" in printed and "18899 échéances" in printed


def test_entry_point_keeps_rejects_apart(spark, golden, tmp_path, capsys):
    """One broken record does not stop the delivery: it is published apart and the rest is built."""
    from ledgerflow import run
    from ledgerflow.sources.text_files import EXTRACT_FILES

    for table, name in EXTRACT_FILES.items():
        write_raw_csv(golden.raw[table], str(tmp_path / "in" / name))
    broken = tmp_path / "in" / EXTRACT_FILES["produits"] / "part-broken.csv"
    broken.write_text(",".join(RAW_COLUMNS["produits"]) + "\nP999,too,few\n", encoding="utf-8")
    run.main(["--extracts", str(tmp_path / "in"), "--root", str(tmp_path / "out"), "--keep-rejects"])
    assert "Modèle validé : 61 contrôles" in capsys.readouterr().out
    rejects = publish.read_published(spark, str(tmp_path / "out/rejects"))["rejets"].collect()
    assert [(r.nom_table, r.cellules, r.enregistrement) for r in rejects] == [("produits", 3, "P999,too,few")]


@pytest.mark.parametrize("record", ["P1,a,b,c,d,e", "P1,a,b", 'P1,"a\nb",c,d,e'])
def test_malformed_records_stop_the_load(spark, tmp_path, record):
    path = tmp_path / "produits.csv"
    path.write_text("produit_id,nom_produit,famille_produit,univers,niveau_complexite\n" + record + "\n", encoding="utf-8")
    with pytest.raises(Exception, match="MALFORMED"):
        read_raw_csv(spark, "produits", str(path)).collect()


def test_line_breaks_in_quotes(spark, tmp_path):
    path = tmp_path / "produits.csv"
    path.write_text('produit_id,nom_produit,famille_produit,univers,niveau_complexite\nP1,"a\nb",c,d,e\n', encoding="utf-8")
    assert [tuple(r) for r in read_raw_csv(spark, "produits", str(path), multi_line=True).collect()] == [("P1", "a\nb", "c", "d", "e")]


def test_manifest_is_observed_while_writing(spark, tmp_path):
    root = str(tmp_path / "layer")
    even = {"t": {"pairs": F.count_if(F.col("id") % 2 == 0)}}
    layer = publish.publish(spark, root, {"t": spark.range(9), "u": spark.range(0)}, figures=even)
    for read in (layer, publish.read_published(spark, root)):
        assert read.info["t"].figures == {"rows": 9, "pairs": 5} and read.info["u"].rows == 0
        assert read.info["t"].columns == ["`id` bigint"]
    plan = layers.volume_report(layer)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan
    assert sorted(map(tuple, layers.volume_report(layer).collect())) == [("t", 9), ("u", 0)]


def test_rewritten_files_are_counted_again(spark, tmp_path):
    layer = publish.publish(spark, str(tmp_path / "layer"), {"t": spark.range(9), "u": spark.range(5)})
    spark.range(4).write.mode("append").parquet(f"{layer.folder}/t")
    assert layer.changed("t") and not layer.changed("u")
    again = publish.read_published(spark, str(tmp_path / "layer"))
    assert sorted(map(tuple, layers.volume_report(again).collect())) == [("t", 13), ("u", 5)]


def test_one_of_two_writers_wins(spark, tmp_path):
    """Both start from version 1; both are ready to switch before either does."""
    from concurrent.futures import ThreadPoolExecutor
    from threading import Barrier

    root = str(tmp_path / "layer")
    publish.publish(spark, root, {"t": spark.range(1)})
    ready = Barrier(2)

    def run(rows):
        try:
            publish.publish(spark, root, {"t": spark.range(rows)}, verify_all=lambda _: ready.wait(60))
            return rows
        except publish.ConcurrentPublication:
            return None

    with ThreadPoolExecutor(2) as pool:
        outcome = [r for r in pool.map(run, (20, 30)) if r]
    assert len(outcome) == 1
    assert publish.read_published(spark, root)["t"].count() == outcome[0]
    assert [v.sequence for v in publish.versions(spark, root)] == [1, 2]


def test_log_entry_is_created_once(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    log = Files(spark, str(tmp_path))
    (tmp_path / "log").mkdir()
    with ThreadPoolExecutor(8) as pool:
        made = list(pool.map(lambda i: log.create_if_absent("log/1.json", f"{i}" * 1000), range(16)))
    assert sum(made) == 1 and (tmp_path / "log/1.json").read_text() == f"{made.index(True)}" * 1000
    assert [p.name for p in (tmp_path / "log").iterdir() if not p.name.endswith(".crc")] == ["1.json"]


def test_outdated_and_failed_versions_go_after_their_time(spark, tmp_path):
    root = str(tmp_path / "layer")
    first = publish.publish(spark, root, {"t": spark.range(3)})

    def refuse(_):
        raise GuardFailed("no")

    with pytest.raises(GuardFailed):
        publish.publish(spark, root, {"t": spark.range(4)}, verify=refuse)
    second = publish.publish(spark, root, {"t": spark.range(5)})
    # A reader of the first version still has it, by its name too.
    assert first["t"].count() == 3 and publish.read_published(spark, root, 1)["t"].count() == 3
    assert len(Files(spark, root).folders()) == 4
    gone = publish.retire(spark, root, retention=0)
    assert len(gone) == 2 and first.folder.endswith(tuple(gone))
    assert second["t"].count() == 5 and publish.retire(spark, root, retention=0) == []


def test_a_deleted_table_is_named(spark, golden, tmp_path):
    import shutil

    from ledgerflow.plans import controls, warehouse

    root = str(tmp_path / "w")
    small = {t: df.limit(5) for t, df in golden.raw.items()}
    raw = warehouse.load_raw(spark, small, root)
    shutil.copytree(golden.mart.folder, tmp_path / "mart")
    mart = publish.Layer(spark, str(tmp_path / "mart"), golden.mart.info)
    shutil.rmtree(f"{mart.folder}/fact_credits")
    with pytest.raises(layers.MissingTables, match="mart.fact_credits .created by facts."):
        controls.controls(golden.staging, mart)
    assert controls.required_present(golden.staging, mart).first()[0] == 15
    shutil.rmtree(f"{raw.folder}/clients")
    with pytest.raises(layers.MissingTables, match="raw.clients .created by raw load."):
        warehouse.build_staging(spark, raw, root)
    with pytest.raises(FileNotFoundError, match="clients"):
        publish.read_published(spark, f"{root}/raw")


def test_missing_columns_are_named(spark, golden, tmp_path):
    from ledgerflow.plans import warehouse

    cut = {t: df.limit(1) for t, df in golden.raw.items()} | {"agences": golden.raw["agences"].drop("ville").limit(1)}
    raw = warehouse.load_raw(spark, cut, str(tmp_path / "w"))
    with pytest.raises(layers.MissingTables, match="agences: ville"):
        warehouse.build_staging(spark, raw, str(tmp_path / "w"))
