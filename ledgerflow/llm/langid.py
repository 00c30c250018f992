"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import apart, map_arrow, record, schema, shards, together

BUCKETS = 1 << 16
SMOOTHING = 0.5
# The classifier is fitted on about so many labelled texts, an equal share for each language, drawn by a hash of the text.
TRAINING_ROWS = 30_000
# A matrix of this many languages still fits every executor.
MAX_LANGUAGES = 256
UNKNOWN = "und"


@cache
def _letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the 2- and 3-grams around every letter of all texts, and how many each text has.

    Whatever is no letter counts as one and the same boundary.
    """
    texts = [t.lower() for t in texts]
    joined = "\n\n".join(["", *texts, ""])
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _letters()[points]
    points = np.where(letter, points, 32).astype(np.uint32)
    at = np.flatnonzero(letter)
    one, two, three = points[at - 1], points[at], points[at + 1]
    with np.errstate(over="ignore"):
        pair = one * np.uint32(0x9E3779B1) ^ two * np.uint32(0x85EBCA77)
        triple = (pair * np.uint32(0xC2B2AE3D)) ^ (three * np.uint32(0x27D4EB2F))
        pair = (pair ^ (pair >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        triple = (triple ^ (triple >> np.uint32(15))) * np.uint32(0x297A2D39)
    found = np.empty(2 * len(at), np.uint32)
    found[0::2], found[1::2] = pair >> np.uint32(16), triple >> np.uint32(16)
    ends = np.cumsum([2] + [len(t) + 2 for t in texts])
    per_text = np.diff(np.searchsorted(at, ends)) * 2
    return found, per_text


class Model:
    """Log probabilities (bucket x language) and log priors."""

    def __init__(self, languages: list[str], matrix: np.ndarray, priors: np.ndarray):
        self.languages, self.matrix, self.priors = languages, matrix, priors

    def score(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Predicted language and its posterior for each text.

        The batch is a sparse matrix of texts by buckets in row order (one entry
        for each gram); its product with the log probabilities is a sum of
        matrix rows over each text.
        """
        found, per_text = grams(texts)
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        some = np.flatnonzero(per_text)
        labels = np.full(len(texts), UNKNOWN, object)
        scores = np.zeros(len(texts))
        if len(some):
            begins = (np.cumsum(per_text) - per_text)[some]
            total = np.stack(
                [np.add.reduceat(column[found], begins, dtype=np.float64) for column in self.matrix.T], axis=1
            )
            total += self.priors
            total -= total.max(axis=1, keepdims=True)
            posterior = np.exp(total)
            posterior /= posterior.sum(axis=1, keepdims=True)
            best = posterior.argmax(axis=1)
            labels[some] = np.array(self.languages, object)[best]
            scores[some] = posterior[np.arange(len(some)), best]
        return labels.tolist(), scores


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", rows: int = TRAINING_ROWS) -> Model:
    """The model of the distinct texts that have a language.

    A language with more than its share of ``rows`` (``rows`` / languages) is
    fitted on about that many of its texts, a rarer one on all of them; copies
    of a text are one, so that none is drawn many times over. Every language's
    counts weigh the same: a gram that none has seen says nothing, however few
    texts a language has. A language without any letter is left out. Gram counts
    are summed by Spark; the driver gets at most ``BUCKETS`` counts for each of
    at most ``MAX_LANGUAGES`` languages; more are an error, as one matrix is
    broadcast.
    """
    labelled = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(text).alias("text"), F.col(lang).alias("lang"), F.xxhash64(F.col(text), F.col(lang)).alias("drawn")
    )
    # Narrow rows, and copies are combined before they move.
    sizes = labelled.select("lang", "drawn").distinct().groupBy("lang").count().orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    share = rows / max(len(sizes), 1)
    steps = 1 << 40
    limits = {r["lang"]: int(steps * share / r["count"]) for r in sizes if r["count"] > share}
    if limits:
        limit = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair])
        labelled = labelled.where(F.pmod("drawn", F.lit(steps)) < F.coalesce(F.try_element_at(limit, F.col("lang")), F.lit(steps)))
    labelled = labelled.dropDuplicates(["lang", "drawn"]).select("text", "lang")
    out = schema(("lang", "string"), ("bucket", "int"), ("n", "long"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for shard in shards(batches, "text"):
            found, per_text = grams(shard.column("text").to_pylist())
            names = np.array(shard.column("lang").to_pylist(), object)
            of = np.repeat(names, per_text)
            for name in set(names.tolist()):
                own = counts.setdefault(name, np.zeros(BUCKETS, np.int64))
                own += np.bincount(found[of == name], minlength=BUCKETS)
        for name, own in counts.items():
            some = np.flatnonzero(own)
            yield record(out, {"lang": [name] * len(some), "bucket": some, "n": own[some]})

    summed = map_arrow(labelled, count, out).groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    counted = summed["lang"].to_pylist()
    languages = sorted(set(counted))
    counts = np.zeros((BUCKETS, len(languages)))
    number = {name: i for i, name in enumerate(languages)}
    counts[summed["bucket"].to_numpy(), [number[name] for name in counted]] = summed["n"].to_numpy()
    totals = counts.sum(axis=0)
    mass = totals.max(initial=0)
    matrix = np.log((counts * (mass / totals) + SMOOTHING) / (mass + SMOOTHING * BUCKETS))
    texts = {r["lang"]: r["count"] for r in sizes}
    priors = np.log(np.array([texts[name] for name in languages], float) / max(sum(texts.values()), 1))
    return Model(languages, matrix.astype(np.float32), priors)


def identify(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns (all, unless given), ``lang_pred`` and ``score``; columns of these names are replaced.

    A text that is null or has no letter is ``und`` with score 0, and so is
    every text if nothing was learned. Rows are independent: repeated rows and
    null keys are no matter. The matrix (``BUCKETS`` x languages) is broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [c for c in (docs.columns if keep is None else keep) if c not in ("lang_pred", "score")]
    rows = apart(docs.select(*[f"`{c}`" for c in dict.fromkeys([*names, text])]), text)
    fields = [rows.schema["row"], *([rows.schema["body"]] if text in names else [])]
    out = schema(*fields, ("lang_pred", "string"), ("score", "double"))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for shard in shards(batches, "body"):
            labels, scores = model.score([t or "" for t in shard.column("body").to_pylist()])
            same = {f.name: shard.column(f.name) for f in fields}
            yield record(out, same | {"lang_pred": labels, "score": scores})

    judged = map_arrow(rows, predict, out)
    return judged.select(*together(judged, names, text), "lang_pred", "score")
