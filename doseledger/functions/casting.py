"""Tolerant casts and rounding with the ledger's semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_away(value: Column, digits: int) -> Column:
    """Round a double after scaling it, so that 1.005 to two places stays 1.0."""
    scale = float(10**digits)
    return F.round(value * F.lit(scale), 0) / F.lit(scale)


def text_to_double(text: Column) -> Column:
    """Text to double, NULL when it is no number.

    The JVM also accepts ``12d``, ``3f`` and hexadecimal floats; those are no numbers here.
    """
    return F.when(~text.rlike(r"[0-9.][dDfF]\s*$|[xX]"), text.try_cast("double"))


def _whole(value: Column) -> Column:
    return F.when(F.abs(value) < F.lit(9.2233720368547748e18), value.try_cast("bigint"))


def text_to_bigint(text: Column) -> Column:
    """Text to bigint; fractions round half away from zero, NULL when it is no number."""
    return F.coalesce(text.try_cast("bigint"), _whole(F.round(text_to_double(text), 0)))


def double_to_bigint(value: Column) -> Column:
    """Double to bigint; fractions round half to even."""
    return _whole(F.rint(value))


def _marked_missing(text: Column) -> Column:
    return F.nullif(F.nullif(text, F.lit("")), F.lit("NULL"))


def safe_float(text: Column) -> Column:
    """Source text to double: empty, ``NULL`` and malformed values become NULL."""
    return text_to_double(_marked_missing(text))


def safe_int(text: Column) -> Column:
    """Source text to bigint by truncation: ``12.7`` gives 12."""
    return _whole(safe_float(text))


def safe_ratio(cost: Column, items: Column) -> Column:
    """Cost per item to four places; NULL when items is zero or either side is NULL."""
    return round_half_away(cost / F.nullif(items, F.lit(0)), 4)


def blank_text(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def blank_list(values: Column) -> Column:
    return F.coalesce(values, F.array().cast("array<string>"))
