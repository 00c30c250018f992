"""Text-to-type conversions that yield NULL instead of failing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerflow.functions.text import blank_to_null

# Accepted shapes. The cast alone would be too permissive: it reads '2026' as
# a date, '1e3' as a decimal and cuts a timestamp that carries a zone.
DATE_SHAPE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
TIMESTAMP_SHAPE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$"
INT_SHAPE = r"^[+-]?[0-9]+$"
DECIMAL_SHAPE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)$"


def _guarded(c: Column, shape: str, data_type: str, trimmed: bool) -> Column:
    text = c if trimmed else blank_to_null(c)
    return F.when(text.rlike(shape), text.try_cast(data_type))


# ``trimmed`` tells that outer spaces are already gone, so they are not looked for again.


def safe_date(c: Column, *, trimmed: bool = False) -> Column:
    return _guarded(c, DATE_SHAPE, "date", trimmed)


def safe_timestamp(c: Column, *, trimmed: bool = False) -> Column:
    """Zone-less timestamp with whole seconds."""
    return _guarded(c, TIMESTAMP_SHAPE, "timestamp_ntz", trimmed)


def safe_int(c: Column, *, trimmed: bool = False) -> Column:
    return _guarded(c, INT_SHAPE, "int", trimmed)


def safe_decimal(c: Column, precision: int, scale: int, *, trimmed: bool = False) -> Column:
    """Rounds half up to ``scale``; NULL when the integer part does not fit."""
    return _guarded(c, DECIMAL_SHAPE, f"decimal({precision},{scale})", trimmed)


def month_start(c: Column, *, trimmed: bool = False) -> Column:
    """``'2023-01'`` -> 2023-01-01."""
    text = c if trimmed else blank_to_null(c)
    return safe_date(F.concat(text, F.lit("-01")), trimmed=True)
