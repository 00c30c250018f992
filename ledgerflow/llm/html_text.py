"""Main text of web pages: shallow features of flat blocks, classified by a decision tree."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm.common import map_arrow, record, schema, shards
from ledgerflow.llm.html_blocks import Block, blocks

DEPTH = 5
# Words beyond this many say no more.
MOST_WORDS = 100
# Of a block and its neighbours: words, share of them in links; its place (1 in an element
# of the article, -1 in one beside it, 0 if no element says so); whether it is a heading.
FEATURES = ("words", "links", "words_before", "links_before", "words_behind", "links_behind", "place", "heading")

# Blocks labelled by hand (the features in order, then 1 for main text).
LABELLED = (
    # Articles in marked elements: long and short paragraphs, titles, quotes, last lines.
    (12, 0.0, 8, 0.0, 60, 0.0, 1, 1, 1), (9, 0.0, 1, 1.0, 85, 0.02, 1, 1, 1), (60, 0.0, 12, 0.0, 21, 0.0, 1, 0, 1),
    (21, 0.0, 60, 0.0, 45, 0.0, 1, 0, 1), (4, 0.0, 45, 0.0, 88, 0.0, 1, 0, 1), (7, 0.0, 90, 0.0, 9, 0.2, 1, 0, 1),
    (2, 0.0, 30, 0.0, 30, 0.0, 1, 0, 1), (1, 0.0, 30, 0.0, 6, 1.0, 1, 0, 1), (100, 0.1, 100, 0.0, 100, 0.0, 1, 0, 1),
    (35, 0.3, 40, 0.1, 28, 0.0, 1, 0, 1), (5, 0.0, 3, 1.0, 2, 1.0, 1, 0, 1), (16, 0.5, 22, 0.0, 31, 0.1, 1, 0, 1),
    (3, 0.0, 0, 0.0, 0, 0.0, 1, 1, 1), (100, 0.0, 0, 0.0, 0, 0.0, 1, 0, 1), (6, 0.0, 6, 0.0, 6, 0.0, 1, 0, 1),
    (11, 0.1, 1, 1.0, 1, 1.0, 1, 0, 1), (3, 0.3, 15, 0.0, 70, 0.0, 1, 1, 1), (2, 0.5, 55, 0.0, 42, 0.0, 1, 0, 1),
    (5, 1.0, 48, 0.0, 51, 0.0, 1, 1, 1), (4, 1.0, 60, 0.0, 33, 0.0, 1, 0, 1), (8, 1.0, 0, 0.0, 73, 0.0, 1, 1, 1),
    # Short lines of articles among short lines.
    (1, 0.0, 61, 0.0, 1, 0.0, 1, 0, 1), (2, 0.0, 2, 0.0, 2, 0.0, 1, 0, 1), (1, 0.0, 1, 0.0, 1, 0.0, 1, 0, 1),
    (4, 0.0, 9, 0.0, 4, 0.0, 1, 1, 1), (2, 0.0, 11, 0.0, 2, 0.0, 1, 1, 1), (1, 0.0, 9, 0.0, 1, 0.0, 1, 1, 1),
    (5, 0.0, 74, 0.0, 4, 0.0, 1, 0, 1), (3, 0.0, 1, 0.0, 8, 0.0, 1, 0, 1), (6, 0.0, 2, 0.0, 3, 0.0, 1, 0, 1),
    (1, 0.0, 2, 1.0, 2, 0.0, 1, 0, 1), (2, 0.0, 4, 0.0, 1, 1.0, 1, 0, 1), (3, 0.0, 3, 0.0, 25, 0.0, 1, 0, 1),
    (1, 0.0, 0, 0.0, 0, 0.0, 1, 0, 1), (2, 0.0, 7, 0.0, 0, 0.0, 1, 0, 1), (4, 0.0, 1, 0.0, 1, 0.0, 1, 1, 1),
    (30, 0.2, 40, 0.0, 4, 1.0, 1, 0, 1), (12, 0.4, 25, 0.0, 2, 1.0, 1, 0, 1), (50, 0.3, 4, 1.0, 6, 1.0, 1, 0, 1),
    (8, 0.5, 30, 0.0, 12, 0.6, 1, 0, 1), (20, 0.6, 30, 0.0, 25, 0.7, 1, 0, 1), (70, 0.2, 60, 0.0, 3, 0.8, 1, 0, 1),
    # Link lists inside articles.
    (2, 1.0, 2, 1.0, 2, 1.0, 1, 0, 0), (3, 1.0, 1, 1.0, 4, 1.0, 1, 0, 0), (1, 1.0, 3, 1.0, 1, 1.0, 1, 0, 0),
    (5, 1.0, 6, 1.0, 5, 1.0, 1, 0, 0), (2, 1.0, 1, 1.0, 8, 1.0, 1, 0, 0), (4, 1.0, 2, 0.9, 3, 1.0, 1, 0, 0),
    # Whatever stands in menus, headers, footers, side columns, notices, adverts, forms and comments.
    (1, 1.0, 0, 0.0, 1, 1.0, -1, 0, 0), (1, 1.0, 1, 1.0, 1, 1.0, -1, 0, 0), (2, 1.0, 1, 1.0, 9, 0.0, -1, 0, 0),
    (8, 0.0, 1, 1.0, 12, 0.0, -1, 0, 0), (10, 0.0, 1, 1.0, 70, 0.0, -1, 0, 0), (25, 0.0, 8, 0.0, 0, 0.0, -1, 0, 0),
    (40, 0.0, 20, 0.0, 33, 0.0, -1, 0, 0), (95, 0.0, 60, 0.0, 80, 0.0, -1, 0, 0), (18, 0.1, 70, 0.0, 0, 0.0, -1, 0, 0),
    (3, 0.0, 50, 0.0, 12, 0.0, -1, 1, 0), (5, 0.4, 40, 0.0, 4, 0.0, -1, 0, 0), (60, 0.0, 4, 0.0, 45, 0.0, -1, 0, 0),
    (30, 0.0, 90, 0.0, 30, 0.0, -1, 0, 0), (4, 0.0, 80, 0.0, 25, 0.0, -1, 1, 0), (100, 0.05, 100, 0.0, 100, 0.0, -1, 0, 0),
    (2, 1.0, 60, 0.0, 3, 1.0, -1, 0, 0), (9, 0.0, 33, 0.0, 51, 0.0, -1, 0, 0), (14, 0.0, 0, 0.0, 60, 0.0, -1, 1, 0),
    (1, 0.0, 1, 0.0, 1, 0.0, -1, 0, 0), (6, 0.0, 6, 0.0, 40, 0.0, -1, 0, 0), (50, 0.2, 10, 0.0, 22, 0.0, -1, 0, 0),
    # Pages that mark nothing: running text.
    (80, 0.0, 12, 0.0, 65, 0.0, 0, 0, 1), (65, 0.05, 80, 0.0, 40, 0.0, 0, 0, 1), (25, 0.0, 65, 0.0, 50, 0.0, 0, 0, 1),
    (18, 0.0, 40, 0.0, 44, 0.0, 0, 0, 1), (30, 0.1, 9, 0.0, 0, 0.0, 0, 0, 1), (12, 0.0, 35, 0.0, 28, 0.0, 0, 0, 1),
    (100, 0.2, 0, 0.0, 0, 0.0, 0, 0, 1), (8, 0.0, 50, 0.0, 70, 0.0, 0, 0, 1), (5, 0.0, 60, 0.0, 30, 0.0, 0, 0, 1),
    (6, 0.0, 3, 1.0, 70, 0.0, 0, 1, 1), (9, 0.0, 2, 0.5, 45, 0.0, 0, 1, 1), (4, 0.0, 44, 0.0, 61, 0.0, 0, 1, 1),
    (40, 0.0, 5, 1.0, 5, 1.0, 0, 0, 1), (22, 0.0, 2, 1.0, 30, 0.0, 0, 0, 1), (55, 0.3, 30, 0.1, 41, 0.0, 0, 0, 1),
    (16, 0.0, 70, 0.0, 4, 1.0, 0, 0, 1), (3, 0.0, 35, 0.0, 26, 0.0, 0, 0, 1), (14, 0.0, 22, 0.0, 19, 0.0, 0, 0, 1),
    # Pages that mark nothing: menus, labels, lines of links and of rights.
    (1, 1.0, 1, 1.0, 1, 1.0, 0, 0, 0), (2, 1.0, 0, 0.0, 2, 1.0, 0, 0, 0), (3, 1.0, 2, 1.0, 40, 0.0, 0, 0, 0),
    (6, 0.8, 4, 1.0, 5, 1.0, 0, 0, 0), (20, 0.9, 30, 0.7, 12, 1.0, 0, 0, 0), (4, 0.0, 2, 1.0, 1, 1.0, 0, 0, 0),
    (3, 0.0, 0, 0.0, 3, 1.0, 0, 0, 0), (2, 0.0, 1, 0.0, 2, 0.0, 0, 0, 0), (5, 0.0, 3, 1.0, 0, 0.0, 0, 0, 0),
    (8, 0.5, 3, 1.0, 2, 1.0, 0, 0, 0), (1, 0.0, 1, 1.0, 4, 0.0, 0, 0, 0), (7, 0.9, 50, 0.0, 3, 1.0, 0, 0, 0),
    (30, 0.8, 20, 0.6, 25, 0.9, 0, 0, 0), (4, 1.0, 60, 0.0, 4, 1.0, 0, 0, 0), (3, 0.0, 4, 0.0, 2, 1.0, 0, 0, 0),
    (6, 0.0, 2, 0.0, 0, 0.0, 0, 0, 0), (2, 0.0, 5, 1.0, 5, 1.0, 0, 1, 0), (3, 1.0, 4, 1.0, 3, 1.0, 0, 1, 0),
)

# A node: feature, threshold, subtree up to it, subtree above; a leaf: whether its blocks are main text.
Tree = tuple | bool


def train(spark: SparkSession, labelled: tuple = LABELLED, depth: int = DEPTH) -> Tree:
    """The tree that Spark grows on the labelled blocks, as nested tuples."""
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.linalg import Vectors

    rows = [(Vectors.dense(row[:-1]), float(row[-1])) for row in labelled]
    data = spark.createDataFrame(rows, ["features", "label"]).coalesce(1)
    model = DecisionTreeClassifier(maxDepth=depth, maxBins=64, seed=1).fit(data)

    def taken(node) -> Tree:
        if node.subtreeDepth() == 0:
            return node.prediction() == 1.0
        split = node.split()
        return split.featureIndex(), split.threshold(), taken(node.leftChild()), taken(node.rightChild())

    return taken(model._java_obj.rootNode())


def features(found: list[Block]) -> list[tuple]:
    """The features of each block, in the order of ``FEATURES``; beyond the page there are 0 words."""
    shape = [(0, 0.0), *[(min(b.words, MOST_WORDS), b.link_density) for b in found], (0, 0.0)]
    return [
        (*shape[i], *shape[i - 1], *shape[i + 1], -1 if b.aside else int(b.main), int(b.heading)) for i, b in enumerate(found, start=1)
    ]


def judge(tree: Tree, values: tuple) -> bool:
    while not isinstance(tree, bool):
        feature, threshold, low, high = tree
        tree = low if values[feature] <= threshold else high
    return tree


def main_text(page: str, tree: Tree) -> str:
    found = blocks(page)
    return "\n".join(b.text for b, values in zip(found, features(found)) if judge(tree, values))


def extract(pages: DataFrame, tree: Tree, *, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The kept columns and ``text``: the blocks that the tree takes for main text, one to a line.

    A null or empty page, and one without main text, gives an empty text. Rows
    are independent; nothing is shuffled, and the tree travels with the task.
    """
    out = schema(*[pages.schema[c] for c in keep], ("text", "string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in shards(batches, "body"):
            texts = [main_text(page, tree) if page else "" for page in shard.column("body").to_pylist()]
            yield record(out, {c: shard.column(c) for c in keep} | {"text": texts})

    return map_arrow(pages.select(*keep, F.col(html).alias("body")), run, out)
