"""Spark session settings and the shared folder used for written tables."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"

# Rows that one partition of a shuffle should hold before adaptive execution merges small ones.
ROWS_PER_PARTITION = 1 << 18
_FIRST_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"

# Fallback folders of local sessions, by application id.
_local_folders: dict[str, str] = {}


def build_session(
    app_name: str = "ledgerflow",
    master: str | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """Session with adaptive execution: partition sizing, join choice and skew splits at run time."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # The JVM never compiles a method above 8 000 bytes of code: the wide cleaning
        # projections are faster as split projections than as one interpreted loop.
        "spark.sql.codegen.hugeMethodLimit": "8000",
    }
    for key, value in (defaults | (settings or {})).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster.

    Only a local master may fall back to a temporary folder: on a cluster a
    machine-local folder would be lost with its machine.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="ledgerflow-")
    return _local_folders[app]


@contextmanager
def partitions_for(spark: SparkSession, rows: int) -> Iterator[int]:
    """Shuffles start with as many partitions as a table of ``rows`` rows asks for, never fewer than configured.

    A fixed number of partitions makes sorts that outgrow the memory of a task as
    the data grows; adaptive execution merges partitions that turn out small. The
    session's setting is put back afterwards.
    """
    before = spark.conf.get(_FIRST_PARTITIONS, None)
    wanted = max(int(before or spark.conf.get("spark.sql.shuffle.partitions")), 1 + rows // ROWS_PER_PARTITION)
    spark.conf.set(_FIRST_PARTITIONS, str(wanted))
    try:
        yield wanted
    finally:
        if before is None:
            spark.conf.unset(_FIRST_PARTITIONS)
        else:
            spark.conf.set(_FIRST_PARTITIONS, before)
