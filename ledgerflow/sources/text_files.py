"""CSV ingest into all-text raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerflow.sources.schemas import raw_schema

# Header line, comma, double quote, LF, UTF-8. Values are kept as written:
# trimming and typing belong to staging. A doubled quote inside a quoted
# value stands for one quote.
CSV_OPTIONS = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "lineSep": "\n",
    "encoding": "UTF-8",
    # A record with too many or too few cells stops the load: nothing is shifted, cut or filled.
    "mode": "FAILFAST",
    "columnPruning": "false",
    "enforceSchema": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


# Name of each extract inside the delivery folder.
EXTRACT_FILES = {
    "agences": "agences.csv",
    "clients": "clients_raw.csv",
    "credits": "credits_raw.csv",
    "objectifs_agences": "objectifs_agences.csv",
    "produits": "produits.csv",
    "remboursements": "remboursements_raw.csv",
    "transactions": "transactions_raw.csv",
}


def read_extracts(
    spark: SparkSession, folder: str, files: dict[str, str] | None = None, multi_line: bool = False
) -> dict[str, DataFrame]:
    """All raw tables of a delivery; ``files`` overrides single names."""
    names = EXTRACT_FILES | (files or {})
    return {
        table: read_raw_csv(spark, table, f"{folder}/{name}", multi_line) for table, name in names.items()
    }


def read_raw_csv(spark: SparkSession, table: str, path: str, multi_line: bool = False) -> DataFrame:
    """A raw table from a file or a folder of files, every column text.

    A record without the expected number of cells fails the load. Line breaks
    inside quoted values need ``multi_line``, which reads a file as a whole in
    one task; without it such a record fails the load too.
    """
    reader = spark.read.schema(raw_schema(table)).options(**CSV_OPTIONS)
    return reader.option("multiLine", str(multi_line).lower()).csv(path)


def write_raw_csv(df: DataFrame, path: str) -> None:
    """Extract in the same dialect, replaced as a whole on every run."""
    (
        df.write.mode("overwrite")
        .options(header="true", quote='"', escape='"', encoding="UTF-8")
        .options(ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false")
        .csv(path)
    )
