"""Text expressions: label cleaning, strict dates, Spanish month labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spanish month abbreviations used in the history file headers
# (``ene-24`` = January 2024).
SPANISH_MONTHS = {
    "ene": 1, "feb": 2, "mar": 3, "abr": 4, "may": 5, "jun": 6,
    "jul": 7, "ago": 8, "sep": 9, "oct": 10, "nov": 11, "dic": 12,
}


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_unicode(c) -> Column:
    """Remove leading/trailing Unicode whitespace (``trim`` only removes spaces)."""
    return F.regexp_replace(_col(c), r"(?U)^\s+|\s+$", "")


def clean_label(c) -> Column:
    """Lower-case and strip."""
    return F.lower(strip_unicode(c))


def parse_iso_date(c) -> Column:
    """Strict ``YYYY-MM-DD`` parse; anything else becomes null.

    Accepts single-digit month/day like ``2025-1-5``; rejects time suffixes,
    padding and impossible dates such as ``2025-02-30``.
    """
    return F.try_to_date(_col(c), "yyyy-M-d")


def spanish_month_number(label) -> Column:
    """``'ene'`` (any case) -> 1 ... ``'dic'`` -> 12, else null."""
    m = F.create_map(*[x for k, v in SPANISH_MONTHS.items() for x in (F.lit(k), F.lit(v))])
    return F.try_element_at(m, F.lower(_col(label)))


def spanish_month_label(month) -> Column:
    """Inverse of :func:`spanish_month_number`: 1 -> ``'ene'``."""
    m = F.create_map(*[x for k, v in SPANISH_MONTHS.items() for x in (F.lit(v), F.lit(k))])
    return F.try_element_at(m, _col(month).cast("int"))


def contains(c, text: str) -> Column:
    """Case-sensitive substring test."""
    return _col(c).contains(text)
