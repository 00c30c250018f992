"""Business rules on typed columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerflow.functions import domains
from ledgerflow.functions.text import canonical

UNKNOWN_KEY = 0

IMPAYE = "Impayé"
EN_RETARD = "Payé en retard"
A_TEMPS = "Payé à temps"

# Score limits between low / moderate / high risk. The business names the three
# levels without giving limits: these defaults are this library's own choice.
RISK_LIMITS = (40, 70)
# Lower limits of the second, third and fourth income band.
INCOME_LIMITS = (1500, 2500, 4000)


def null_if_negative(c: Column) -> Column:
    """An impossible negative value is unknown, never its absolute value."""
    return F.when(c >= 0, c)


def repayment_status(paid_source: Column, paid_on: Column, delay: Column, label: Column) -> Column:
    """Status rules in order; the source label only decides when none applies.

    ``paid_source`` is the amount before negative values are dropped: a
    negative payment with a date is not an unpaid instalment.
    """
    spellings = domains.spelling_map(
        domains.STATUT_REMBOURSEMENT, domains.UNACCENTED_STATUT_REMBOURSEMENT
    )
    return (
        F.when(paid_on.isNull() | (paid_source == 0), IMPAYE)
        .when(delay > 0, EN_RETARD)
        .when(delay == 0, A_TEMPS)
        .otherwise(canonical(label, spellings))
    )


def side_amount(direction: Column, amount: Column, side: str) -> Column:
    """Absolute amount when the operation is on ``side``, otherwise 0."""
    zero = F.lit(0).cast("decimal(15,2)")
    return (
        F.when(direction == side, F.coalesce(F.abs(amount), zero))
        .otherwise(zero)
        .cast("decimal(15,2)")
    )


def unpaid_amount(expected: Column, paid: Column) -> Column:
    """What is left to pay, at least 0; NULL when either amount is unknown."""
    rest = expected - paid
    return F.when(rest < 0, F.lit(0)).otherwise(rest).cast("decimal(15,2)")


def is_status(status: Column, label: str) -> Column:
    """Flag that is false, not NULL, for an unknown status."""
    return F.coalesce(status == label, F.lit(False))


def key_or_unknown(key: Column) -> Column:
    return F.coalesce(key, F.lit(UNKNOWN_KEY))


def counter() -> Column:
    """Additive counter: one per row."""
    return F.lit(1).cast("smallint")


def income_band(income: Column) -> Column:
    low, middle, high = INCOME_LIMITS
    return (
        F.when(income < low, "Moins de 1 500 €")
        .when(income < middle, "De 1 500 € à 2 499 €")
        .when(income < high, "De 2 500 € à 3 999 €")
        .when(income >= high, "4 000 € et plus")
        .otherwise("Inconnu")
    )


def risk_level(score: Column, limits: tuple[int, int] = RISK_LIMITS) -> Column:
    return (
        F.when(score < limits[0], "Faible")
        .when(score < limits[1], "Modéré")
        .when(score >= limits[1], "Élevé")
        .otherwise("Inconnu")
    )
