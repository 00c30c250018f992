from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from ledgerflow.llm.common import table

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_pack_what_is_left(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    sizes = [docs.count()]
    for _, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == columns
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0
    packed = pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == sizes[-1]
    total = F.sum("length")
    assert pipeline.run(spark, SF).agg(total).first() == packed.agg(total).first()


def test_odd_rows(spark, odd):
    for name, stage in pipeline.STAGES:
        rows = stage(spark, odd, SF)
        assert rows.count() <= odd.count() + 100
        assert stage(spark, odd.limit(0), SF).count() == 0


def test_one_document_of_a_large_copy_group_stays(spark, make):
    """A group of copies above the line ratio: its text reaches the near-dedup whole, and one is kept."""
    copied = "The harbour was closed on Monday because of the storm.\nShips waited two days outside the bay."
    rows = [(i, copied, "en", "a.org", len(copied)) for i in range(30)]
    rows += [(100 + i, " ".join(f"word{i * 31 + k * k}" for k in range(30)), "en", "a.org", 1) for i in range(100)]
    clean = pipeline.without_boilerplate(spark, make(rows), SF)
    assert clean.where(F.col("text") == copied).count() == 30
    assert pipeline.one_of_each(spark, clean, SF).where(F.col("text") == copied).count() == 1
