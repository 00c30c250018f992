"""Boolean columns used by the quality checks.

All of them are two-valued (never NULL), so they can be summed or negated.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerflow.functions import domains
from ledgerflow.functions.text import blank_to_null


def _known(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def any_of(*conditions: Column) -> Column:
    """True when at least one condition holds: a row counts once."""
    return reduce(or_, [_known(c) for c in conditions])


def any_null(*columns: str) -> Column:
    return reduce(or_, [F.col(c).isNull() for c in columns])


def any_blank(*columns: str) -> Column:
    """Missing in a raw table: NULL, empty or spaces only."""
    return reduce(or_, [blank_to_null(F.col(c)).isNull() for c in columns])


def outside_domain(c: Column, labels: tuple[str, ...]) -> Column:
    return c.isNull() | _known(~c.isin(*labels))


def outside_range(c: Column, low, high) -> Column:
    return c.isNull() | _known(~c.between(low, high))


def wrong_code(c: Column, prefix: str, digits: int, *, null_is_wrong: bool = True) -> Column:
    """Not exactly ``prefix`` followed by ``digits`` digits."""
    bad = _known(~c.rlike(f"^{prefix}[0-9]{{{digits}}}$"))
    return (c.isNull() | bad) if null_is_wrong else bad


def wrong_postcode(c: Column) -> Column:
    """Given, but not five characters or holding a non-digit."""
    return _known((F.length(F.rtrim(c)) != 5) | c.rlike("[^0-9]"))


def wrong_email(c: Column) -> Column:
    """Given, but without ``@`` followed later by a dot, or holding a space."""
    return _known(~c.like("%@%.%") | c.contains(" "))


def after(c: Column, as_of: str | Column) -> Column:
    """Later than the reference day, which is a parameter so results repeat."""
    day = F.to_date(F.lit(as_of)) if isinstance(as_of, str) else as_of
    return _known(c > day)


def failed_conversion(source: Column, converted: Column) -> Column:
    """The source holds something, the typed value is NULL."""
    return blank_to_null(source).isNotNull() & converted.isNull()


def differs(before: Column, after_: Column) -> Column:
    """Case- and accent-exact difference; false when either side is NULL."""
    return _known(before != after_)


def differs_or_missing(before: Column, after_: Column) -> Column:
    """Difference where NULL and empty text are the same value."""
    return F.coalesce(before, F.lit("")) != F.coalesce(after_, F.lit(""))


def mojibake(*columns: str) -> Column:
    """Any of the columns still shows a trace of a wrong code page."""
    text = F.concat_ws("", *[F.col(c) for c in columns])
    return reduce(or_, [text.contains(trace) for trace in domains.MOJIBAKE_TRACES])
