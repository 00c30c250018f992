"""Text cleaning and label columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerflow.functions import domains


def blank_to_null(c: Column) -> Column:
    """Outer spaces removed; an empty remainder becomes NULL."""
    return F.nullif(F.trim(c), F.lit(""))


def repair_accents(c: Column) -> Column:
    """Accents damaged by a wrong code page put right.

    The repairs only run on cells that hold the damage marker, so clean
    text costs one search instead of nine replacements.
    """
    repaired = reduce(
        lambda acc, pair: F.replace(acc, F.lit(pair[0]), F.lit(pair[1])), domains.MOJIBAKE, c
    )
    return F.when(F.contains(c, F.lit(domains.MOJIBAKE_LEAD)), repaired).otherwise(c)


def clean_text(c: Column) -> Column:
    """Trim, turn blanks into NULL and repair accents."""
    return repair_accents(blank_to_null(c))


def clean_code(c: Column) -> Column:
    """Cleaned text in upper case: identifiers and currency codes."""
    return F.upper(clean_text(c))


def reference_key(c: Column) -> Column:
    """Form in which identifiers are compared across raw tables."""
    return F.upper(blank_to_null(c))


def canonical(c: Column, spellings: dict[str, str]) -> Column:
    """Replace a known spelling (any case) by its label, keep anything else."""
    entries = [F.lit(part) for item in spellings.items() for part in item]
    return F.coalesce(F.create_map(*entries)[F.upper(c)], c)


def full_name(first: Column, last: Column) -> Column:
    return F.trim(F.concat(F.coalesce(first, F.lit("")), F.lit(" "), F.coalesce(last, F.lit(""))))


def display_label(identifier: Column, name: Column) -> Column:
    """``A001 - Bordeaux Centre``."""
    return F.concat_ws(" - ", identifier, name)


def message(*parts: Column | str) -> Column:
    """Sentence made of literals and values; NULL parts count as empty text."""
    cols = [F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]
    return F.concat(*[F.coalesce(c, F.lit("")) for c in cols])
