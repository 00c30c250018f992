"""End-to-end build: raw -> staging -> dimensions -> facts, each layer published atomically."""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from ledgerflow.plans import controls, dimensions, facts, guards, staging
from ledgerflow.session import partitions_for
from ledgerflow.sources.layers import create_layers, require_columns, require_published
from ledgerflow.sources.publish import Layer, expose, publish, read_published
from ledgerflow.sources.schemas import RAW_COLUMNS

Tables = dict[str, DataFrame]

# Published folders of a root, which are the catalog layers too.
LAYERS = ("raw", "staging", "mart")


@dataclass(frozen=True)
class Warehouse:
    raw: Layer
    staging: Layer
    mart: Layer

    @property
    def dims(self) -> Layer:
        return self.mart.subset(list(dimensions.JOBS))

    @property
    def facts(self) -> Layer:
        return self.mart.subset(list(facts.JOBS))


def load_raw(spark: SparkSession, sources: Tables, root: str) -> Tables:
    """Full reload of the all-text raw tables from their extracts."""
    return publish(spark, f"{root}/raw", sources)


def publish_rejects(spark: SparkSession, rejects: DataFrame, root: str) -> Layer:
    """The broken records of a delivery, as a layer of one table."""
    return publish(spark, f"{root}/rejects", {"rejets": rejects})


# --- fixed values: raw tables, which the load creates ---------------------------
RAW_REQUIRED = tuple((f"raw.{t}", "raw load") for t in RAW_COLUMNS)


def _rows(tables: Tables) -> int:
    """Rows of the largest table, as far as a manifest tells."""
    return max((i.rows for i in tables.info.values()), default=0) if isinstance(tables, Layer) else 0


def build_staging(spark: SparkSession, raw: Tables, root: str) -> Tables:
    require_published(raw, "raw", RAW_REQUIRED)
    require_columns(raw, {t: list(c) for t, c in RAW_COLUMNS.items()})
    with partitions_for(spark, _rows(raw)):
        return publish(
            spark,
            f"{root}/staging",
            {table: partial(job, raw) for table, job in staging.JOBS.items()},
        )


def build_mart(spark: SparkSession, stg: Tables, root: str) -> Tables:
    """Dimensions, then the facts on their keys, as one version.

    Surrogate keys only mean something together with the dimensions they were
    given in, so neither becomes current without the other: a failed guard of
    either leaves the previous mart as it was. Facts are laid out by the month
    of their main date, which report slicers on the calendar prune by.
    """

    require_published(stg, "staging", controls.REQUIRED)

    def facts_on(dims: Tables) -> dict:
        guards.enforce(guards.fact_preconditions(stg, dims))
        return {name: partial(laid_out, name, dims) for name in facts.JOBS if name != "fact_remboursements"}

    def repayments_on(mart: Tables) -> dict:
        """Instalments take their client and branch from the credits as they were written."""
        return {"fact_remboursements": partial(laid_out, "fact_remboursements", mart, mart["fact_credits"])}

    def laid_out(name: str, *given) -> DataFrame:
        return facts.by_month(facts.JOBS[name](stg, *given), facts.MAIN_DATES[name], facts.derived(name))

    with partitions_for(spark, _rows(stg)):
        return publish(
            spark,
            f"{root}/mart",
            {name: partial(job, stg) for name, job in dimensions.JOBS.items()},
            figures=guards.dimension_figures(),
            partition_by={name: [facts.MONTH] for name in facts.JOBS},
            verify=lambda dims: guards.enforce(guards.dimension_guards(stg, dims)),
            then=(facts_on, repayments_on),
            verify_all=lambda mart: guards.enforce(
                guards.fact_guards(stg, mart.subset(list(facts.JOBS)))
            ),
        )


def build(spark: SparkSession, sources: Tables, root: str) -> Warehouse:
    """Every layer reads the published files of the one before, not its lineage."""
    raw = load_raw(spark, sources, root)
    stg = build_staging(spark, raw, root)
    return Warehouse(raw, stg, build_mart(spark, stg, root))


def load(spark: SparkSession, root: str) -> Warehouse:
    """Current version of a warehouse built earlier."""
    return Warehouse(*(read_published(spark, f"{root}/{layer}") for layer in LAYERS))


def register(spark: SparkSession, root: str, prefix: str = "") -> list[str]:
    """Make the current version queryable as ``raw.*``, ``staging.*`` and ``mart.*``."""
    create_layers(spark, prefix)
    return [
        name
        for layer in LAYERS
        for name in expose(spark, f"{root}/{layer}", f"{prefix}{layer}")
    ]
