"""Boilerplate lines: those that a large share of a site's pages contain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import apart, together, written

# Share of a host's distinct pages from which a line counts as boilerplate: banners are far above, phrases that
# several pages happen to share far below.
MAX_RATIO = 0.06
# Distinct pages that must hold the line: one page repeats nothing.
MIN_PAGES = 2


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _identity(line: Column) -> Column:
    return F.md5(F.encode(F.trim(line), "UTF-8"))


def boilerplate(
    pages: DataFrame, host: Column, text: str = "text", max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES
) -> DataFrame:
    """(host, lines): the identities of the lines that exceed the ratio on that host.

    Pages of one host with the same text are one page, in the counts and in the
    host's total, and a line counts once for a page. Both are combined before
    the shuffle, so neither a group of copies nor a line on every page is a hot
    key, and at most lines of a page / ratio identities remain for a host.
    """
    page = pages.select(host.alias("host"), F.col(text).alias("t"))
    held = F.array_distinct(F.transform(F.filter(_lines(F.col("t")), lambda x: F.trim(x) != ""), _identity))
    # Grouped by values of the page alone: copies are combined before the shuffle.
    page = page.select("host", F.md5(F.encode("t", "UTF-8")).alias("page"), held.alias("held")).distinct()
    totals = page.groupBy("host").agg(F.count("*").alias("total"))
    counts = (
        page.select("host", F.explode("held").alias("line"))
        .groupBy("host", "line")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= min_pages)
    )
    return (
        counts.join(totals, "host")
        .where(F.col("n") / F.col("total") > max_ratio)
        .groupBy("host")
        .agg(F.collect_list("line").alias("lines"))
    )


def without_boilerplate(
    pages: DataFrame,
    host: Column,
    text: str = "text",
    max_ratio: float = MAX_RATIO,
    min_pages: int = MIN_PAGES,
    counts: bool = False,
) -> DataFrame:
    """The pages with boilerplate lines taken out of ``text``.

    ``host`` is lower-cased by the caller if need be; pages whose host is null
    are one site of their own. A null text stays null, an empty one empty;
    blank lines are never boilerplate; a page may lose all its lines and is then
    empty. Rows are never dropped. Repeated rows and copies count as one page, so
    that they do not make their own lines boilerplate and are left whole to a
    deduplication. A site is judged by the same ratio whatever its size. Lines
    are compared without the spaces around them; texts are read whole, other
    columns may have any name. ``counts`` adds ``n_lines`` and ``n_dropped``.

    The pages meet their host's list only; a page is never cut into rows, so
    texts are not shuffled by line.
    """
    sites = apart(pages, text, F.coalesce(host, F.lit("")).alias("host"))
    # Written first: Spark then knows the size of the lists when it picks the join.
    found = written(boilerplate(sites, F.col("host"), "body", max_ratio, min_pages), "boilerplate")
    joined = sites.join(found.withColumnRenamed("lines", "bad"), "host", "left").withColumn("all", _lines(F.col("body")))
    kept = F.when(F.col("bad").isNull(), F.col("all")).otherwise(
        F.filter("all", lambda x: ~F.array_contains(F.col("bad"), _identity(x)))
    )
    joined = joined.withColumn("kept", kept).withColumn(
        "body", F.when(F.col("body").isNotNull(), F.array_join("kept", "\n"))
    )
    sizes = [F.size("all").cast("long").alias("n_lines"), (F.size("all") - F.size("kept")).cast("long").alias("n_dropped")]
    return joined.select(*together(joined, pages.columns, text), *(sizes if counts else []))
