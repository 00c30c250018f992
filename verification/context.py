"""Layers of one scale folder, published once per session and then read from files."""

from __future__ import annotations

import threading
import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ledgerflow.plans import dimensions, facts, warehouse
from ledgerflow.session import shared_folder
from verification.testbed import raw_layer

Tables = dict[str, DataFrame]

_contexts: dict[tuple[str, str], Context] = {}
_lock = threading.RLock()


class Context:
    """Each layer is built on first use, from the published files of the one before."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.root = f"{shared_folder(spark)}/warehouse-{uuid.uuid4().hex[:12]}"

    @cached_property
    def sources(self) -> Tables:
        """Raw tables as plans over the driver tables."""
        return raw_layer(self.spark, self.sf_dir)

    @cached_property
    def raw(self) -> Tables:
        with _lock:
            return warehouse.load_raw(self.spark, self.sources, self.root)

    @cached_property
    def staging(self) -> Tables:
        with _lock:
            return warehouse.build_staging(self.spark, self.raw, self.root)

    @cached_property
    def mart(self) -> Tables:
        with _lock:
            return warehouse.build_mart(self.spark, self.staging, self.root)

    @property
    def dims(self) -> Tables:
        return self.mart.subset(list(dimensions.JOBS))

    @property
    def facts(self) -> Tables:
        return self.mart.subset(list(facts.JOBS))


def context(spark: SparkSession, sf_dir: str) -> Context:
    key = (spark.sparkContext.applicationId, sf_dir)
    with _lock:
        if key not in _contexts:
            _contexts[key] = Context(spark, sf_dir)
        return _contexts[key]
