"""Declarative checks: many metrics, one scan, one row per metric."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OK = "OK"
ATTENTION = "ATTENTION"
INFO = "INFO"

REPORT_COLUMNS = ("famille", "nom_table", "controle", "valeur", "statut")


@dataclass(frozen=True)
class Check:
    """A counted metric; ``limit`` is the accepted value, None when only informative."""

    family: str
    name: str
    value: Column
    limit: int | None = 0


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def unpivot(row: DataFrame, value_type: str = "bigint") -> DataFrame:
    """One wide row -> (mesure, valeur) rows."""
    cells = ", ".join(f"'{c}', cast(`{c}` as {value_type})" for c in row.columns)
    return row.selectExpr(f"stack({len(row.columns)}, {cells}) as (mesure, valeur)")


def run(df: DataFrame, table: str, checks: list[Check]) -> DataFrame:
    """All checks of a table in one aggregate."""
    wide = df.agg(*[c.value.alias(f"m{i}") for i, c in enumerate(checks)])
    return _report(wide, table, [(c.family, c.name, f"m{i}", c.limit) for i, c in enumerate(checks)])


def single(df: DataFrame, family: str, table: str, limit: int | None = 0) -> DataFrame:
    """Report rows from a one-row frame whose columns are the metrics."""
    return _report(df, table, [(family, c, c, limit) for c in df.columns])


def _report(wide: DataFrame, table: str, lines: list[tuple[str, str, str, int | None]]) -> DataFrame:
    cells = ", ".join(
        f"'{family}', '{table}', '{name}', cast(`{column}` as bigint), {_status(column, limit)}"
        for family, name, column, limit in lines
    )
    return wide.selectExpr(f"stack({len(lines)}, {cells}) as ({', '.join(REPORT_COLUMNS)})")


def _status(column: str, limit: int | None) -> str:
    if limit is None:
        return f"'{INFO}'"
    return f"case when `{column}` = {limit} then '{OK}' else '{ATTENTION}' end"


def offenders(
    df: DataFrame, condition: Column, columns: list, order: list, n: int | None = None
) -> DataFrame:
    """Rows behind a check: all, or the first ``n`` in a total order."""
    rows = df.where(condition).select(*columns)
    return rows if n is None else rows.orderBy(*order).limit(n)
