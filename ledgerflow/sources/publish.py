"""All-or-nothing publication of a set of tables, with a manifest of what was written.

Tables are written to a new version folder, verified there, and only then
named current by one entry of the version log, which is created if and only if
no other writer has taken that number: of two writers that started from the
same version one wins and the other is told. A failed build leaves the previous
version current and untouched; readers keep the version they opened. Rows and
other figures are observed while the files are written and kept in the entry,
so that volumes and guards need not read the tables again.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerflow.sources.files import Files

_LOG = "_versions"
_ENTRY = (
    "sequence bigint, folder string, published_at bigint,"
    " tables array<struct<name:string,columns:array<string>,figures:map<string,bigint>,fingerprint:string>>"
)
ROWS = "rows"
# Seconds for which a version that is no longer current, or never was, can still be read.
RETENTION = 7 * 24 * 3600


class ConcurrentPublication(RuntimeError):
    """Another writer published first; the version written here was never current."""


@dataclass(frozen=True)
class TableInfo:
    """What is known of a published table without reading it."""

    name: str
    columns: list[str]
    figures: dict[str, int]
    fingerprint: str

    @property
    def rows(self) -> int:
        return self.figures[ROWS]

    @property
    def column_names(self) -> list[str]:
        return [c.split("`")[1] for c in self.columns]


@dataclass(frozen=True)
class Version:
    sequence: int
    folder: str
    published_at: int
    tables: dict[str, TableInfo] = field(default_factory=dict)


class Layer(dict):
    """Published tables by name; ``info`` is their manifest, ``folder`` where they lie."""

    def __init__(self, spark: SparkSession, folder: str, info: dict[str, TableInfo], frames: dict[str, DataFrame] | None = None):
        # The manifest knows the columns: no file is opened for them.
        super().__init__(
            frames or {n: spark.read.schema(", ".join(i.columns)).parquet(f"{folder}/{n}") for n, i in info.items()}
        )
        self.spark, self.folder, self.info = spark, folder, info

    def subset(self, names: list[str]) -> Layer:
        return Layer(self.spark, self.folder, {n: self.info[n] for n in names}, {n: self[n] for n in names})

    def changed(self, name: str) -> bool:
        """Whether the table's files are not those that were published: the manifest no longer speaks for them."""
        return Files(self.spark, self.folder).fingerprint(name) != self.info[name].fingerprint

    def present(self) -> list[str]:
        """The tables whose files are there."""
        files = Files(self.spark, self.folder)
        return [name for name in self.info if files.exists(name)]


def versions(spark: SparkSession, root: str) -> list[Version]:
    """All versions of the log, oldest first. The log has one short entry per publication."""
    if not Files(spark, root).exists(_LOG):
        return []
    entries = spark.read.schema(_ENTRY).json(f"{root}/{_LOG}").collect()
    found = [
        Version(
            e["sequence"], f"{root}/{e['folder']}", e["published_at"],
            {t["name"]: TableInfo(t["name"], list(t["columns"]), dict(t["figures"]), t["fingerprint"]) for t in e["tables"]},
        )
        for e in entries
    ]
    return sorted(found, key=lambda v: v.sequence)


def current_version(spark: SparkSession, root: str) -> tuple[int, str, list[str]] | None:
    """(sequence, folder, tables) of the version readers should use."""
    known = versions(spark, root)
    return (known[-1].sequence, known[-1].folder, list(known[-1].tables)) if known else None


def publish(
    spark: SparkSession,
    root: str,
    tables: dict[str, DataFrame | Callable[[], DataFrame]],
    verify: Callable[[Layer], None] | None = None,
    partition_by: dict[str, list[str]] | None = None,
    parallel: int = 4,
    then: tuple[Callable[[Layer], dict[str, DataFrame | Callable[[], DataFrame]]], ...] = (),
    verify_all: Callable[[Layer], None] | None = None,
    figures: dict[str, dict[str, Column]] | None = None,
    retention: int = RETENTION,
) -> Layer:
    """Write, verify, then switch. Returns the published tables.

    Each step of ``then`` gives further tables that are built from those written
    so far; they belong to the same version, which ``verify_all`` sees as a
    whole. Nothing becomes current unless everything passed. ``figures`` are aggregates per
    table that are observed during its write besides the number of rows.

    The tables of a layer do not depend on each other: ``parallel`` of them
    are submitted at a time, so the tail of one job overlaps the next. A table
    may be given as a function, called when its turn comes. Versions that have
    not been current for ``retention`` seconds are removed afterwards.
    """
    known = versions(spark, root)
    sequence = known[-1].sequence + 1 if known else 1
    name = f"v{sequence}-{uuid.uuid4().hex[:12]}"
    folder = f"{root}/{name}"
    files = Files(spark, folder)

    def write(table: str) -> TableInfo:
        given = wanted[table]
        df = given() if callable(given) else given
        columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields]
        observation = Observation()
        # Observed by the tasks that write, each of which counts once however often it is tried.
        observed = {ROWS: F.count(F.lit(1)), **(figures or {}).get(table, {})}
        df = df.observe(observation, *[c.cast("bigint").alias(n) for n, c in observed.items()])
        writer = df.write.mode("errorifexists")
        by = (partition_by or {}).get(table)
        (writer.partitionBy(*by) if by else writer).parquet(f"{folder}/{table}")
        counted = {n: int(observation.get[n] or 0) for n in observed}
        return TableInfo(table, columns, counted, files.fingerprint(table))

    def write_all(names: list[str]) -> dict[str, TableInfo]:
        with ThreadPoolExecutor(max_workers=parallel) as pool:
            return {i.name: i for i in pool.map(inheritable_thread_target(spark)(write), names)}

    wanted = dict(tables)
    info = write_all(list(tables))
    if verify:
        verify(Layer(spark, folder, info))
    for step in then:
        more = step(Layer(spark, folder, info))
        wanted |= more
        info |= write_all(list(more))
    written = Layer(spark, folder, info)
    if verify_all:
        verify_all(written)
    entry = {"sequence": sequence, "folder": name, "published_at": int(time.time()), "tables": [asdict(i) for i in info.values()]}
    log = Files(spark, root)
    if not log.create_if_absent(f"{_LOG}/{sequence:09d}.json", json.dumps(entry, ensure_ascii=False)):
        log.remove(name)
        raise ConcurrentPublication(f"version {sequence} of {root} was published by another writer")
    retire(spark, root, retention)
    return written


def retire(spark: SparkSession, root: str, retention: int = RETENTION) -> list[str]:
    """Remove the folders of versions that have not been current for ``retention`` seconds, or never were.

    A version stays readable that long after its successor was published; a
    folder without log entry (a failed build, or one still running) that long
    after its last change. The log itself is kept. Returns the removed folders.
    """
    known = versions(spark, root)
    # The time from which a version is outdated; the current one has none.
    since = {v.folder: later.published_at for v, later in zip(known, known[1:], strict=False)}
    current = known[-1].folder if known else None
    files, now, gone = Files(spark, root), time.time(), []
    for name, changed in files.folders().items():
        folder = f"{root}/{name}"
        if name == _LOG or not name.startswith("v") or folder == current:
            continue
        if now - since.get(folder, changed) >= retention:
            files.remove(name)
            gone.append(name)
    return gone


def read_published(spark: SparkSession, root: str, sequence: int | None = None) -> Layer:
    """Tables of the current version, or of an earlier one that is still there."""
    known = [v for v in versions(spark, root) if sequence in (None, v.sequence)]
    if not known:
        raise FileNotFoundError(f"nothing published under {root}" + (f" as version {sequence}" if sequence else ""))
    version = known[-1]
    files = Files(spark, version.folder)
    gone = [name for name in version.tables if not files.exists(name)]
    if gone:
        raise FileNotFoundError(f"files of {', '.join(gone)} are gone from {version.folder}")
    return Layer(spark, version.folder, version.tables)


def expose(spark: SparkSession, root: str, database: str) -> list[str]:
    """Point one catalog view per table at the current version; returns their names."""
    layer = read_published(spark, root)
    views = [f"{database}.{name}" for name in layer]
    for view, name in zip(views, layer, strict=True):
        spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM parquet.`{layer.folder}/{name}`")
    return views
