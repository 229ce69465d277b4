"""Dates and month keys of ledger records.

Source files write ``202506``; hand-made extracts write ``2025-06-01``. Both give ``2025-06``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_ISO = (
    r"^\s*(?:\d{4}-\d{1,2}-\d{1,2}|\d{4}/\d{1,2}/\d{1,2})"
    r"(?:[ T]\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?)?\s*$"
)
_COMPACT = r"^\s*\d{4}(?:0?[1-9]|1[0-2])\s*$"


def iso_date(text: Column) -> Column:
    """A date from ISO text. Spark alone would also read ``202506`` as the year 202506.

    Text with the dashes and the last digit of ``YYYY-MM-DD`` is left to the cast, which judges its other characters as the pattern does;
    text without dash or slash is none. Only the rest goes through the pattern.
    """
    plain = (
        (F.length(text) == 10) & (F.substring(text, 5, 1) == "-") & (F.substring(text, 8, 1) == "-")
        & F.substring(text, 10, 1).between("0", "9")
    )
    other = (text.contains("-") | text.contains("/")) & text.rlike(_ISO)
    return F.when(plain | other, F.translate(F.trim(text), "/", "-").try_cast("date"))


def month_key(text: Column, date: Column | None = None) -> Column:
    """``YYYY-MM`` from ``YYYYMM`` or from an ISO date, else NULL.

    ``date`` is the text's :func:`iso_date`, where that is at hand already.
    """
    compact = F.trim(text)
    date = iso_date(text) if date is None else date
    # no text is both; the date is there already
    return F.when(date.isNotNull(), F.substring(date.cast("string"), 1, 7)).when(
        text.rlike(_COMPACT),
        F.concat(F.substring(compact, 1, 4), F.lit("-"), F.lpad(F.substring(compact, 5, 2), 2, "0")),
    )


def month_start(key: Column) -> Column:
    """First day of a ``YYYY-MM`` month."""
    return F.concat(key, F.lit("-01")).try_cast("date")
