"""Edge rows of the column functions."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerflow.functions import dates, domains, parsing, rules, text
from ledgerflow.functions import predicates as P


def evaluate(spark, column, **values):
    """Result of a column expression on one row of typed literals."""
    row = spark.range(1).select(*[F.expr(v).alias(k) for k, v in values.items()])
    return row.select(column.alias("r")).first()["r"]


def text_literal(value):
    return "cast(null as string)" if value is None else f"'{value}'"


@pytest.mark.parametrize(
    "given, wanted",
    [
        ("  M├⌐rignac ", "Mérignac"),
        ("   ", None),
        (None, None),
        ("├ëtudiant", "Étudiant"),
        ("Bordeaux Centre", "Bordeaux Centre"),
        ("├¿├º├ç├è├á├¬├┤", "èçÇÊàêô"),
        ("reste ├x", "reste ├x"),
    ],
)
def test_clean_text(spark, given, wanted):
    assert evaluate(spark, text.clean_text(F.col("x")), x=text_literal(given)) == wanted


@pytest.mark.parametrize(
    "given, wanted",
    [
        ("2024-02-29", dt.date(2024, 2, 29)),
        (" 2024-02-29 ", dt.date(2024, 2, 29)),
        ("2026-13-40", None),
        ("2026-02-30", None),
        ("", None),
        ("2026", None),
        ("2026-1-4", None),
        (None, None),
    ],
)
def test_safe_date(spark, given, wanted):
    assert evaluate(spark, parsing.safe_date(F.col("x")), x=text_literal(given)) == wanted


@pytest.mark.parametrize(
    "given, wanted",
    [
        ("1.005", Decimal("1.01")),
        ("-1.005", Decimal("-1.01")),
        ("abc", None),
        ("1e3", None),
        ("12345678901", None),
        ("1234567890.12", Decimal("1234567890.12")),
        ("-5", Decimal("-5.00")),
        (".5", Decimal("0.50")),
        ("", None),
    ],
)
def test_safe_decimal(spark, given, wanted):
    assert evaluate(spark, parsing.safe_decimal(F.col("x"), 12, 2), x=text_literal(given)) == wanted


@pytest.mark.parametrize(
    "given, wanted", [("12", 12), (" -7 ", -7), ("12.5", None), ("", None), ("99999999999", None)]
)
def test_safe_int(spark, given, wanted):
    assert evaluate(spark, parsing.safe_int(F.col("x")), x=text_literal(given)) == wanted


@pytest.mark.parametrize(
    "given, wanted",
    [
        ("2023-01-01 01:20:23", dt.datetime(2023, 1, 1, 1, 20, 23)),
        ("2026-13-40 10:00:00", None),
        ("2023-01-01", None),
        ("2023-01-01 25:00:00", None),
    ],
)
def test_safe_timestamp(spark, given, wanted):
    assert evaluate(spark, parsing.safe_timestamp(F.col("x")), x=text_literal(given)) == wanted


@pytest.mark.parametrize(
    "given, wanted", [("2023-01", dt.date(2023, 1, 1)), (None, None), ("2023-13", None), ("", None)]
)
def test_month_start(spark, given, wanted):
    assert evaluate(spark, parsing.month_start(F.col("x")), x=text_literal(given)) == wanted


@pytest.mark.parametrize(
    "given, wanted",
    [("PRÊT IMMOBILIER", "Prêt immobilier"), ("prêt personnel", "Prêt personnel"), ("Autre", "Autre"), (None, None)],
)
def test_canonical(spark, given, wanted):
    column = text.canonical(F.col("x"), domains.spelling_map(domains.TYPE_CREDIT))
    assert evaluate(spark, column, x=text_literal(given)) == wanted


@pytest.mark.parametrize(
    "paid, paid_on, delay, label, wanted",
    [
        ("100", "null", "0", "Payé à temps", "Impayé"),
        ("0", "date'2024-01-01'", "0", "Payé à temps", "Impayé"),
        ("-20", "date'2024-01-01'", "3", "Payé à temps", "Payé en retard"),
        ("null", "date'2024-01-01'", "0", "x", "Payé à temps"),
        ("50", "date'2024-01-01'", "null", "paye a temps", "Payé à temps"),
        ("50", "date'2024-01-01'", "null", "PAYÉ EN RETARD", "Payé en retard"),
        ("50", "date'2024-01-01'", "-1", "autre", "autre"),
    ],
)
def test_repayment_status(spark, paid, paid_on, delay, label, wanted):
    column = rules.repayment_status(F.col("p"), F.col("d"), F.col("j"), F.col("l"))
    values = dict(p=f"cast({paid} as decimal(15,2))", d=f"cast({paid_on} as date)", j=f"cast({delay} as int)")
    assert evaluate(spark, column, **values, l=f"'{label}'") == wanted


@pytest.mark.parametrize(
    "expected, paid, wanted",
    [("100", "null", None), ("100", "120", "0.00"), ("100", "40", "60.00"), ("null", "40", None)],
)
def test_unpaid_amount(spark, expected, paid, wanted):
    column = rules.unpaid_amount(F.col("e"), F.col("p"))
    got = evaluate(spark, column, e=f"cast({expected} as decimal(15,2))", p=f"cast({paid} as decimal(15,2))")
    assert got == (Decimal(wanted) if wanted else None)


@pytest.mark.parametrize(
    "side, amount, debit, credit",
    [("'Débit'", "-100", 100, 0), ("'Crédit'", "50", 0, 50), ("null", "50", 0, 0), ("'Débit'", "null", 0, 0)],
)
def test_side_amounts(spark, side, amount, debit, credit):
    values = dict(s=f"cast({side} as string)", a=f"cast({amount} as decimal(15,2))")
    assert evaluate(spark, rules.side_amount(F.col("s"), F.col("a"), "Débit"), **values) == debit
    assert evaluate(spark, rules.side_amount(F.col("s"), F.col("a"), "Crédit"), **values) == credit


@pytest.mark.parametrize(
    "income, band",
    [("1499.99", "Moins de 1 500 €"), ("1500", "De 1 500 € à 2 499 €"), ("2500", "De 2 500 € à 3 999 €"),
     ("4000", "4 000 € et plus"), ("null", "Inconnu")],
)
def test_income_band(spark, income, band):
    assert evaluate(spark, rules.income_band(F.col("x")), x=f"cast({income} as decimal(12,2))") == band


def test_names_and_flags(spark):
    assert evaluate(spark, text.full_name(F.col("a"), F.col("b")), a="cast(null as string)", b="'Durand'") == "Durand"
    assert evaluate(spark, text.display_label(F.col("a"), F.col("b")), a="'A001'", b="'Bordeaux'") == "A001 - Bordeaux"
    assert evaluate(spark, rules.is_status(F.col("a"), "Impayé"), a="cast(null as string)") is False
    assert evaluate(spark, rules.null_if_negative(F.col("a")), a="cast(-1 as decimal(6,3))") is None
    assert evaluate(spark, text.message("n = ", F.col("a"), "."), a="cast(null as int)") == "n = ."


def test_month_boundaries_count_changes_not_days(spark):
    column = dates.month_boundaries(F.col("a"), F.col("b"))
    assert evaluate(spark, column, a="date'2023-01-31'", b="date'2023-02-01'") == 1
    assert evaluate(spark, column, a="date'2022-12-01'", b="date'2024-01-31'") == 13


@pytest.mark.parametrize(
    "email, wrong",
    [("a@b.fr", False), ("a@b", True), ("a b@c.fr", True), ("sans", True), (None, False)],
)
def test_wrong_email(spark, email, wrong):
    assert evaluate(spark, P.wrong_email(F.col("x")), x=text_literal(email)) is wrong


def test_predicates_are_never_null(spark):
    nothing = "cast(null as string)"
    assert evaluate(spark, P.wrong_code(F.col("x"), "A", 3), x=nothing) is True
    assert evaluate(spark, P.wrong_code(F.col("x"), "A", 3, null_is_wrong=False), x=nothing) is False
    assert evaluate(spark, P.outside_domain(F.col("x"), ("a",)), x=nothing) is True
    assert evaluate(spark, P.differs(F.col("x"), F.lit("a")), x=nothing) is False
    assert evaluate(spark, P.differs_or_missing(F.col("x"), F.lit("")), x=nothing) is False
    assert evaluate(spark, P.wrong_postcode(F.col("x")), x="'3300A'") is True
    assert evaluate(spark, P.mojibake("x"), x="'├x'") is True
