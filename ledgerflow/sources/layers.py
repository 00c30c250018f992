"""Layered tables in the catalog, guards and volume reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.sources.publish import ROWS, Layer

LAYERS = ("raw", "staging", "mart", "reporting")


class MissingTables(RuntimeError):
    """Raised before a job starts when tables it needs do not exist."""


def create_layers(spark: SparkSession, prefix: str = "", location: str | None = None) -> list[str]:
    """Create the layer databases that do not exist yet."""
    names = [f"{prefix}{layer}" for layer in LAYERS]
    for name in names:
        where = f" LOCATION '{location}/{name}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{where}")
    return names


def replace_table(df: DataFrame, name: str, partition_by: list[str] | None = None) -> None:
    """Idempotent full reload of a catalog table."""
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)


def require_tables(spark: SparkSession, required: list[tuple[str, str]]) -> None:
    """``required`` lists (table, job that creates it); all missing ones are named at once."""
    missing = [f"{t} (created by {job})" for t, job in required if not spark.catalog.tableExists(t)]
    if missing:
        raise MissingTables("Missing tables: " + " ; ".join(missing))


def require_published(tables: dict[str, DataFrame], layer: str, required: list[tuple[str, str]]) -> None:
    """Every table of ``layer`` that ``required`` names is there, with files if it was published.

    Called before a job reads anything, so that a missing table is named at
    once and not found out by a failed scan.
    """
    wanted = {name.partition(".")[2]: job for name, job in required if name.partition(".")[0] == layer}
    there = present_tables(tables)
    missing = [f"{layer}.{t} (created by {job})" for t, job in wanted.items() if t not in there]
    if missing:
        raise MissingTables("Missing tables: " + " ; ".join(missing))


def present_tables(tables: dict[str, DataFrame]) -> list[str]:
    return tables.present() if isinstance(tables, Layer) else list(tables)


def require_columns(tables: dict[str, DataFrame], wanted: dict[str, list[str]]) -> None:
    """Every table holds its columns; the schema, or a published table's manifest, says so."""
    wrong = {
        t: sorted(set(columns) - set(tables.info[t].column_names if isinstance(tables, Layer) else tables[t].columns))
        for t, columns in wanted.items()
    }
    if any(wrong.values()):
        raise MissingTables("Missing columns: " + " ; ".join(f"{t}: {', '.join(c)}" for t, c in wrong.items() if c))


def counted(tables: dict[str, DataFrame], name: str, figure: str = ROWS, otherwise: Column | None = None) -> DataFrame:
    """One row (``n``): a figure of a table, by its manifest if the files are still those it speaks for.

    A table that was not published, or whose files were changed since, is read:
    ``otherwise`` is the aggregate that gives the figure, its rows by default.
    """
    df = tables[name]
    if isinstance(tables, Layer) and figure in tables.info[name].figures and not tables.changed(name):
        return df.sparkSession.range(1).select(F.lit(tables.info[name].figures[figure]).cast("bigint").alias("n"))
    return df.agg((F.count(F.lit(1)) if otherwise is None else otherwise).cast("bigint").alias("n"))


def missing_tables_message(present: DataFrame, required: DataFrame) -> DataFrame:
    """The same guard as data: one row, NULL message when nothing is missing.

    ``required`` is a short literal list, which bounds the aggregated text.
    """
    gone = required.join(present, "nom_table", "left_anti")
    label = F.concat("nom_table", F.lit(" — créée par "), "createur")
    return gone.agg(
        F.count(F.lit(1)).alias("tables_manquantes"),
        F.concat_ws(" ; ", F.array_sort(F.collect_list(label))).alias("message"),
    )


def volume_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table."""
    parts = [
        counted(tables, name).select(F.lit(name).alias("nom_table"), F.col("n").alias("nombre_lignes")) for name in tables
    ]
    return reduce(DataFrame.unionByName, parts)


def column_report(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """Column count per table, from the schemas alone."""
    rows = [(name, column) for name, df in tables.items() for column in df.columns]
    listed = spark.createDataFrame(rows, "nom_table string, colonne string")
    return listed.groupBy("nom_table").agg(F.count(F.lit(1)).alias("nombre_colonnes"))


def catalog_column_report(spark: SparkSession, database: str) -> DataFrame:
    """Column count of every table of a database."""
    rows = [
        (t.name, c.name)
        for t in spark.catalog.listTables(database)
        for c in spark.catalog.listColumns(f"{database}.{t.name}")
    ]
    listed = spark.createDataFrame(rows, "nom_table string, colonne string")
    return listed.groupBy("nom_table").agg(F.count(F.lit(1)).alias("nombre_colonnes"))


def preview(df: DataFrame, n: int, *order: str) -> DataFrame:
    """Small sample in a fixed order."""
    return df.orderBy(*order).limit(n)
