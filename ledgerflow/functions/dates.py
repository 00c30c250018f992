"""Date arithmetic and French calendar names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerflow.functions import domains


def date_key(d: Column) -> Column:
    """Date as the integer yyyymmdd."""
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def month_boundaries(first: Column, last: Column) -> Column:
    """Number of month changes between two dates (31 January -> 1 February is 1)."""
    return (F.year(last) - F.year(first)) * 12 + F.month(last) - F.month(first)


def weekday_number(d: Column) -> Column:
    """Monday = 1 ... Sunday = 7."""
    return F.weekday(d) + 1


def _name(names: tuple[str, ...], position: Column) -> Column:
    return F.get(F.array(*[F.lit(n) for n in names]), position - 1)


def day_name(d: Column) -> Column:
    return _name(domains.JOURS, weekday_number(d))


def month_name(d: Column) -> Column:
    return _name(domains.MOIS, F.month(d))


def french_date(d: Column) -> Column:
    return F.date_format(d, "dd/MM/yyyy")
