"""CSV deliveries that keep what is broken, and files whose records hold line breaks, read by many tasks.

A record with too many or too few cells goes to a reject table as it was
received, the others load. A large file with line breaks inside quotes is read
block by block: a line begins a record if the number of quotes before it is
even, and that number is a sum over the blocks before plus one within the block.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerflow.sources.schemas import RAW_COLUMNS
from ledgerflow.sources.text_files import CSV_OPTIONS, EXTRACT_FILES

_BROKEN = "_broken"
# Lines of one record beyond which a quote was never closed: such lines are rejected one by one,
# so that a stray quote does not gather the rest of its file in one task.
MAX_LINES = 10_000
REJECT_COLUMNS = ("nom_table", "fichier", "cellules", "enregistrement")


class Delivery(NamedTuple):
    """Raw tables, and the records that are none (``nom_table``, ``fichier``, ``cellules``, ``enregistrement``)."""

    tables: dict[str, DataFrame]
    rejects: DataFrame


def _quotes(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, line, text) of every physical line; ``line`` orders the lines of a block."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        F.col("value").alias("text"),
    )


def records(spark: SparkSession, path: str, max_lines: int = MAX_LINES) -> DataFrame:
    """(file, number, text, whole) of every record, line breaks inside quotes included; number 0 is the header.

    Blocks are read and counted in parallel. Per block there is one row with its
    quotes and, for both states it may begin in, the records that begin in it;
    sums over those short lists give the state and the number each block begins
    with. Only records of several lines are gathered, ``max_lines`` at most;
    lines beyond come back one by one and not ``whole``.
    """
    before = Window.partitionBy("file", "block").orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    counted = lines(spark, path).withColumn("quotes", _quotes(F.col("text")))
    # Even or odd number of quotes before the line, within its block.
    placed = counted.withColumn("odd", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
    blocks = placed.groupBy("file", "block").agg(
        F.sum("quotes").alias("quotes"), F.count_if(F.col("odd") == 0).alias("if_even"), F.count_if(F.col("odd") == 1).alias("if_odd")
    )
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    opened = blocks.withColumn("inside", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2)
    begun = F.when(F.col("inside") == 0, F.col("if_even")).otherwise(F.col("if_odd"))
    starts = opened.select("file", "block", "inside", F.coalesce(F.sum(begun).over(earlier), F.lit(0)).alias("first"))

    inside = (F.col("odd") + F.col("inside")) % 2
    upto = Window.partitionBy("file", "block").orderBy("line").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = (
        placed.join(F.broadcast(starts), ["file", "block"])
        .withColumn("begins", inside == 0)
        .withColumn("number", F.col("first") + F.sum(F.col("begins").cast("int")).over(upto) - 1)
    )
    alone = F.col("begins") & (F.col("quotes") % 2 == 0)
    single = numbered.where(alone).select("file", "number", "text", F.lit(True).alias("whole"))
    parts = numbered.where(~alone)
    sizes = parts.groupBy("file", "number").agg(F.count(F.lit(1)).alias("parts"))
    several = parts.join(sizes, ["file", "number"])
    # Blocks of a file lie in order, lines in order within a block.
    gathered = several.where(F.col("parts") <= max_lines).groupBy("file", "number").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "line", "text"))), lambda x: x["text"]), "\n").alias("text"),
        (F.sum("quotes") % 2 == 0).alias("whole"),
    )
    loose = several.where(F.col("parts") > max_lines).select("file", "number", "text", F.lit(False).alias("whole"))
    return single.union(gathered).union(loose)


def _schema(table: str) -> str:
    return ", ".join(f"`{c}` string" for c in (*RAW_COLUMNS[table], _BROKEN))


def _options() -> dict[str, str]:
    return {**CSV_OPTIONS, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN}


def _cells(record: Column) -> Column:
    """Cells of a record: separators outside quotes, and one."""
    bare = F.regexp_replace(record, '"[^"]*"', "")
    return (F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1).cast("bigint")


def _split(parsed: DataFrame, table: str) -> Delivery:
    # Always true: Spark refuses a scan of the broken text alone, as a count would be.
    parsed = parsed.where(F.length(F.coalesce(RAW_COLUMNS[table][0], F.lit(""))) >= 0)
    good = parsed.where(F.col(_BROKEN).isNull()).select(*RAW_COLUMNS[table])
    rejects = parsed.where(F.col(_BROKEN).isNotNull()).select(
        F.lit(table).alias("nom_table"), F.col("_file").alias("fichier"), _cells(F.col(_BROKEN)).alias("cellules"),
        F.col(_BROKEN).alias("enregistrement"),
    )
    return Delivery({table: good}, rejects)


def read_extract(
    spark: SparkSession, table: str, path: str, multi_line: bool = False, max_lines: int = MAX_LINES, header: bool = True
) -> Delivery:
    """A raw table and its rejects, from a file or a folder of files.

    Without ``multi_line`` a line is a record, and one whose quote stays open is
    rejected like one with too many or too few cells. Blank lines are none.
    """
    if not multi_line:
        read = spark.read.schema(_schema(table)).options(**_options()).option("header", str(header).lower()).csv(path)
        return _split(read.select("*", F.col("_metadata.file_path").alias("_file")), table)
    found = records(spark, path, max_lines).where((F.col("number") >= int(header)) & (F.trim("text") != ""))
    options = {k: v for k, v in _options().items() if k not in ("header", "columnPruning", "enforceSchema", "lineSep", "encoding")}
    cells = F.from_csv("text", _schema(table), options)
    parsed = found.select("whole", F.col("file").alias("_file"), "text", cells.alias("c")).select(
        "_file", *[F.col(f"c.{c}").alias(c) for c in RAW_COLUMNS[table]],
        F.when(~F.col("whole"), F.col("text")).otherwise(F.col(f"c.{_BROKEN}")).alias(_BROKEN),
    )
    return _split(parsed, table)


def read_delivery(spark: SparkSession, folder: str, files: dict[str, str] | None = None, multi_line: bool = False) -> Delivery:
    """All raw tables of a delivery and one table of everything that was rejected; ``files`` overrides single names."""
    parts = {t: read_extract(spark, t, f"{folder}/{n}", multi_line) for t, n in (EXTRACT_FILES | (files or {})).items()}
    tables = {t: part.tables[t] for t, part in parts.items()}
    return Delivery(tables, reduce(DataFrame.union, [part.rejects for part in parts.values()]))


def reconciliation(raw: dict[str, DataFrame], rejects: DataFrame, received: dict[str, DataFrame]) -> DataFrame:
    """Records received, loaded and rejected per table; ``ecart`` is what is in neither (0).

    ``received`` holds the records of each table as ``records`` finds them, by
    a count that parses nothing.
    """
    rejected = rejects.groupBy("nom_table").agg(F.count(F.lit(1)).alias("lignes_rejetees"))
    rows = reduce(
        DataFrame.union,
        [
            received[t].where((F.col("number") > 0) & (F.trim("text") != "")).agg(F.count(F.lit(1)).alias("enregistrements")).select(
                F.lit(t).alias("nom_table"), "enregistrements", df.agg(F.count(F.lit(1))).scalar().alias("lignes_raw")
            )
            for t, df in raw.items()
        ],
    )
    joined = rows.join(rejected, "nom_table", "left").withColumn("lignes_rejetees", F.coalesce("lignes_rejetees", F.lit(0)))
    return joined.withColumn("ecart", F.col("enregistrements") - F.col("lignes_raw") - F.col("lignes_rejetees"))
