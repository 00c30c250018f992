"""Deliveries with broken records, and records of several lines read by several tasks."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from ledgerflow.sources.delivery import read_extract, reconciliation, records
from ledgerflow.sources.schemas import RAW_COLUMNS
from ledgerflow.sources.text_files import read_raw_csv

COLUMNS = RAW_COLUMNS["produits"]
HEAD = ",".join(COLUMNS) + "\n"


def delivered(delivery):
    """Loaded rows, and rejects as (cells, record)."""
    rows = sorted(tuple(r) for r in delivery.tables["produits"].collect())
    return rows, sorted((r.cellules, r.enregistrement) for r in delivery.rejects.collect())


@pytest.mark.parametrize("multi_line", [False, True])
def test_broken_records_are_kept_apart(spark, tmp_path, multi_line):
    body = 'P1,a,b,c,d\nP2,a,b,c\n\nP3,"a, ""x""",b,c,d\nP4,a,b,c,d,e,f\nP5,,,,\n'
    (tmp_path / "f.csv").write_text(HEAD + body, encoding="utf-8")
    rows, rejects = delivered(read_extract(spark, "produits", str(tmp_path / "f.csv"), multi_line))
    assert rows == [("P1", "a", "b", "c", "d"), ("P3", 'a, "x"', "b", "c", "d"), ("P5", None, None, None, None)]
    assert rejects == [(4, "P2,a,b,c"), (7, "P4,a,b,c,d,e,f")]


def test_line_breaks_inside_quotes(spark, tmp_path):
    body = 'P1,"a\nb",c,d,e\nP2,"x\n\n""y""\n",c,d,e\nP3,short\nP4,a,b,"\n",e\n'
    (tmp_path / "f.csv").write_text(HEAD + body, encoding="utf-8")
    rows, rejects = delivered(read_extract(spark, "produits", str(tmp_path / "f.csv"), True))
    assert rows == [("P1", "a\nb", "c", "d", "e"), ("P2", 'x\n\n"y"\n', "c", "d", "e"), ("P4", "a", "b", "\n", "e")]
    assert rejects == [(2, "P3,short")]
    whole = read_raw_csv(spark, "agences", str(tmp_path / "f.csv"), multi_line=True)  # the plain reader stops
    with pytest.raises(Exception, match="MALFORMED"):
        whole.collect()


def test_one_file_is_read_by_several_tasks(spark, tmp_path):
    """Blocks of a few hundred bytes: records begin, go on and end in any of them."""
    rng = random.Random(8)
    want = []
    with open(tmp_path / "f.csv", "w", newline="", encoding="utf-8") as file:
        out = csv.writer(file, lineterminator="\n", quoting=csv.QUOTE_MINIMAL)
        out.writerow(COLUMNS)
        for i in range(600):
            text = "".join(rng.choice(["a", "é", " ", ",", '"', "\n", "b"]) for _ in range(rng.choice([0, 5, 40, 400])))
            row = (f"P{i}", text or "t", "x", f"{i}\n{i}" if i % 7 == 0 else "y", "z")
            want.append(row)
            out.writerow(row)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        found = records(spark, str(tmp_path / "f.csv"))
        assert found.select("file").distinct().count() == 1
        assert spark.read.text(str(tmp_path / "f.csv")).rdd.getNumPartitions() > 50
        delivery = read_extract(spark, "produits", str(tmp_path / "f.csv"), True)
        assert delivered(delivery) == (sorted(want), [])
        assert sorted(r.number for r in found.select("number").collect()) == list(range(601))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_an_open_quote_gathers_no_file(spark, tmp_path):
    """Lines behind a quote that is never closed come back one by one."""
    body = "P1,a,b,c,d\n" + 'P2,"a,b,c,d\n' + "".join(f"Q{i},a,b,c,d\n" for i in range(50))
    (tmp_path / "f.csv").write_text(HEAD + body, encoding="utf-8")
    rows, rejects = delivered(read_extract(spark, "produits", str(tmp_path / "f.csv"), True, max_lines=20))
    assert rows == [("P1", "a", "b", "c", "d")] and len(rejects) == 51
    rows, rejects = delivered(read_extract(spark, "produits", str(tmp_path / "f.csv"), True))
    assert rows == [("P1", "a", "b", "c", "d")] and len(rejects) == 1


@pytest.mark.parametrize("multi_line", [False, True])
def test_received_records_are_reconciled(spark, tmp_path, multi_line):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.csv").write_text(HEAD + "P1,a,b,c,d\nP2,a\n", encoding="utf-8")
    (tmp_path / "in/b.csv").write_text(HEAD + "P3,a,b,c,d\nP4,a,b,c,d\n\nP5,a,b,c,d,e\n", encoding="utf-8")
    delivery = read_extract(spark, "produits", str(tmp_path / "in"), multi_line)
    received = {"produits": records(spark, str(tmp_path / "in"))}
    row = reconciliation(delivery.tables, delivery.rejects, received).first()
    assert (row.enregistrements, row.lignes_raw, row.lignes_rejetees, row.ecart) == (5, 3, 2, 0)
    lost = {"produits": delivery.tables["produits"].where(F.col("produit_id") != "P3")}
    assert reconciliation(lost, delivery.rejects, received).first().ecart == 1
    assert {r.fichier.rsplit("/", 1)[1] for r in delivery.rejects.collect()} == {"a.csv", "b.csv"}
