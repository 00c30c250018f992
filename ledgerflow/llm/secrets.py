"""Secret scan: candidate credentials in texts, judged by who else in the corpus has them."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import map_arrow, record, schema, shards, spread_left_join, written

# The kinds in order, their patterns and least lengths.
KINDS = ("assign", "access", "hex", "live")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
LEAST_VALUE, LEAST_ACCESS = 6, 20
# Words of values that are there to be replaced.
PLACEHOLDERS = ("example", "sample", "changeme", "placeholder", "your", "dummy", "xxxx", "0000", "1234", "test")

# A value that at most so many owners, and repositories, hold is theirs; one with more is a copied example.
MAX_OWNERS = 2
MAX_REPOSITORIES = 8
# Shape of a live credential: length and bits for each character.
LIVE_LENGTH = 12
LIVE_ENTROPY = 2.8


def find(text: str) -> list[tuple[int, int, int, int]]:
    """(kind, start, end, start of the value) of all base matches, in code points."""
    found = []
    low = text.lower()
    if any(word in low for word in KEYWORDS):
        found += [(0, m.start(), m.end(), m.start(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    if "AKIA" in text:
        found += [(1, m.start(), m.end(), m.start()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    found += [(2, m.start(), m.end(), m.start()) for m in HEX.finditer(text)]
    return found


def looks_live(value: str) -> bool:
    """Long, mixed and no placeholder."""
    if len(value) < LIVE_LENGTH or any(word in value.lower() for word in PLACEHOLDERS):
        return False
    counts = Counter(value).values()
    return -sum(n / len(value) * math.log2(n / len(value)) for n in counts) >= LIVE_ENTROPY


def scan(docs: DataFrame, key: str, text: str, owner: Column, repository: Column) -> DataFrame:
    """For each row its key, owner, repository, base spans and candidate values as digests; never the values.

    ``row`` numbers the rows: the task's number and a running number.
    """
    span = "array<struct<start:int,kind:int,end:int,value:int,digest:binary,live:boolean>>"
    rows = docs.select(F.col(key).alias("key"), owner.alias("owner"), repository.alias("repository"), F.col(text).alias("body"))
    out = schema(("row", "long"), *[rows.schema[c] for c in ("key", "owner", "repository")], ("spans", span))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for shard in shards(batches, "body"):
            spans = []
            for body in shard.column("body").to_pylist():
                own = []
                for kind, start, end, value in find(body) if body else ():
                    secret = body[value:end]
                    digest = hashlib.sha256(secret.encode()).digest()[:16]
                    own.append({"start": start, "kind": kind, "end": end, "value": value, "digest": digest, "live": looks_live(secret)})
                spans.append(own)
            yield record(
                out,
                {c: shard.column(c) for c in ("key", "owner", "repository")}
                | {"row": np.arange(number, number + shard.num_rows), "spans": spans},
            )
            number += shard.num_rows

    return map_arrow(rows, search, out)


def ownership(scanned: DataFrame) -> DataFrame:
    """(digest, n, owners, repositories): how many rows, distinct owners and distinct repositories hold a value.

    Counted in steps, each combined before its shuffle: a value that a third of
    the corpus holds is a few rows. Repositories of a null owner are an owner
    each, and so are rows that have neither.
    """
    held = scanned.select("owner", "repository", F.explode(F.array_distinct("spans.digest")).alias("digest"))
    by_repository = held.groupBy("digest", "owner", "repository").agg(F.count("*").alias("n"))
    by_owner = by_repository.groupBy("digest", "owner").agg(
        F.sum("n").alias("n"),
        F.count("repository").alias("repositories"),
        F.sum(F.when(F.col("repository").isNull(), F.col("n")).otherwise(1)).alias("apart"),
    )
    return by_owner.groupBy("digest").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("owner").isNull(), F.col("apart")).otherwise(1)).alias("owners"),
        F.sum("repositories").alias("repositories"),
    )


def secrets(
    docs: DataFrame,
    owner: Column,
    repository: Column,
    *,
    key: str = "doc_id",
    text: str = "text",
    max_owners: int = MAX_OWNERS,
    max_repositories: int = MAX_REPOSITORIES,
) -> DataFrame:
    """One row per row: ``key``, ``spans`` (start, kind, end), ``n_live`` and ``n_copied``.

    Base spans are all matches of the patterns. A value that looks live and
    that only few owners and repositories hold adds a span of kind ``live``
    (the value alone); values beyond that are copied examples. Null and empty
    texts have no spans; null and repeated keys are rows like others, and
    repeated rows count as one owner; an empty table gives no row.
    """
    scanned = written(scan(docs, key, text, owner, repository), "secrets")
    owners = written(ownership(scanned), "owners")
    mine = (F.col("owners") <= max_owners) & (F.col("repositories") <= max_repositories)
    held = scanned.select("row", F.explode("spans").alias("s")).select("row", "s.*")
    verdict = owners.select("digest", mine.alias("mine"))
    judged = spread_left_join(held, verdict, "digest", owners.select("digest", "n"), F.xxhash64("row"))
    live = F.struct(F.col("value").alias("start"), F.lit(3).alias("kind"), "end")
    added = judged.groupBy("row").agg(
        F.collect_set(F.when(F.col("live") & F.col("mine"), live)).alias("added"),
        F.count(F.when(~F.col("mine"), 1)).alias("n_copied"),
    )
    base = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    return scanned.join(added, "row", "left").select(
        F.col("key").alias(key),
        F.array_sort(F.concat(base, F.coalesce("added", none))).alias("spans"),
        F.size(F.coalesce("added", none)).cast("long").alias("n_live"),
        F.coalesce("n_copied", F.lit(0)).alias("n_copied"),
    )


def spelled(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )
