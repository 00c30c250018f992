import pytest
from pyspark.sql import Row

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text[, lang[, source]]) rows."""

    def build(rows, schema=DOCS):
        width = len(schema.split(","))
        return spark.createDataFrame([Row(*r, *[None] * (width - len(r))) for r in rows], schema)

    return build


@pytest.fixture(scope="session")
def odd(spark, make):
    """Nulls everywhere, empty and very long texts, ties, repeated rows, clashing extra columns."""
    rows = [(None, None), (None, "a b c"), (1, None), (2, ""), (3, "   \n\n "), (4, "word " * 60_000), (5, "x" * 200_000)]
    rows += [(6, "same text of two rows here"), (6, "same text of two rows here"), (7, "same text of two rows here"), (8, "é日本 ß\x00\x85")]
    frame = make(rows)
    for name in ("row", "body", "fp", "key", "host", "n", "score", "root", "_part", "component_id"):
        frame = frame.selectExpr("*", f"'clash' as `{name}`")
    return frame
