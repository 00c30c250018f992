"""Registered queries of the operators and, where SQL can say it, their oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm import (
    decontamination,
    exact,
    filter_audit,
    html_text,
    langid,
    licenses,
    lines,
    neighbours,
    packing,
    repeats,
    secrets,
    simhash,
    spelling,
)
from ledgerflow.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
TOKENIZER = "word_bpe_49k.json"


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path(TOKENIZER))


def held_out(key: Column) -> Column:
    """Rows never learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


@query
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    n_hit = F.expr("aggregate(zip_with(span_ends, span_starts, (b, a) -> b - a), 0L, (x, y) -> x + y)")
    return decontamination.contamination(docs, benchmark).select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


@query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


@query
def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(~held_out(F.col("doc_id"))))
    return langid.identify(docs, model, keep=["doc_id"]).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )


@query
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sites are the sources of the documents; documents of one text are one page of their site."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return lines.without_boilerplate(docs, F.col("source"), counts=True).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.encode("text", "UTF-8"), 256).alias("text_sha256")
    )


ORACLE["op7_line_dedup"] = f"""
with docs as (select row_number() over () r, doc_id, coalesce(source, '') host, text from documents),
pages as (select distinct host, text from docs),
lines as (
  select r, host, unnest(string_split(coalesce(text, ''), chr(10))) line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) p from docs),
held as (select distinct host, text, trim(unnest(string_split(text, chr(10))), ' ') line from pages),
counts as (select host, line, count(*) n from held where line <> '' group by all),
totals as (select host, count(*) total from pages group by host),
bad as (select host, line from counts join totals using (host)
        where n >= {lines.MIN_PAGES} and n / total > {lines.MAX_RATIO}),
judged as (select l.r, l.p, l.line, b.line is null as good
           from lines l left join bad b on b.host = l.host and b.line = trim(l.line, ' ')),
joined as (select r, count(*) n_lines, count(*) filter (not good) n_dropped,
           coalesce(string_agg(line, chr(10) order by p) filter (good), '') clean from judged group by r)
select doc_id, n_lines, n_dropped, case when text is not null then sha256(clean) end text_sha256
from joined join docs using (r)
"""


@query
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document's owner is its source, its repository the document: rows with the same text are one."""
    docs = table(spark, sf_dir, "documents")
    found = secrets.secrets(docs, F.col("source"), F.md5(F.encode("text", "UTF-8")))
    base = F.filter("spans", lambda s: s["kind"] < 3)

    def count(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(secrets.spelled(base), 256).alias("base_sha256"),
        secrets.spelled(F.col("spans")).alias("spans"),
        "n_live",
        "n_copied",
    )


@query
def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licenses(table(spark, sf_dir, "documents")).select(
        "doc_id", F.array_join("licenses", ",").alias("licenses"), "n_candidates", "containment"
    )


@query
def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_text.extract(pages, html_text.train(spark)).withColumn("n_chars", F.length("text").cast("long"))


@query
def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.without_repeats(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("span_starts").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact.groups(table(spark, sf_dir, "documents"))
    return found.toDF("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLE["op11_exact_dedup"] = f"""
with docs as (select doc_id, translate(coalesce(text, ''), '{exact.UPPER}', '{exact.LOWER}') t from documents)
select doc_id, max(doc_id) over same keep_id, count(*) over same group_size,
       doc_id = max(doc_id) over same kept, sha256(t) text_sha256
from docs window same as (partition by t)
"""


@query
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLE["op12_filter_audit"] = filter_audit.oracle_sql()


def misspelt(key: Column, word: Column) -> Column:
    """The word without one letter for one row and word in 31, as crc32 of both decides."""
    lower = F.translate(word, exact.UPPER, exact.LOWER)
    h = F.crc32(F.encode(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), lower), "UTF-8"))
    at = F.pmod(h, F.length(lower)).cast("int")
    cut = F.concat(F.substring(lower, F.lit(1), at), F.substring(lower, at + 2, F.length(lower)))
    return F.when(h % 31 == 0, cut).otherwise(lower)


@query
def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    words = spelling.vocabulary(docs, "text", lambda run: misspelt(F.col("doc_id"), run))
    return spelling.variants(words)
