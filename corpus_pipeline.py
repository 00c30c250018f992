"""A corpus made ready for training: language, boilerplate, near duplicates, benchmark, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm import decontamination, langid, lines, packing, simhash
from ledgerflow.llm.catalog import held_out, tokenizer_path
from ledgerflow.llm.common import table, written

# A prediction less certain than this is no language the model knows.
MIN_SCORE = 0.5


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model recognises; texts without a letter go."""
    model = langid.fit(docs.where(~held_out(F.col("doc_id"))))
    judged = langid.identify(docs, model)
    good = (F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= MIN_SCORE)
    return judged.where(good).select(*docs.columns)


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that too many documents of their source share; ``n_chars`` follows.

    Copies count once: they are the next stage's, which keeps one of them with its text.
    """
    clean = lines.without_boilerplate(docs, F.col("source"))
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.representatives(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in training sequences."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("language_id", identified),
    ("line_dedup", without_boilerplate),
    ("simhash_near_dedup", one_of_each),
    ("decontamination", uncontaminated),
    ("packing", packed),
]

# Language model, fingerprints and tokenizer are beyond SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
