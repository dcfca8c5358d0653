"""Numeric expressions: the report rounding rule, exact sums, casts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# Sums are accumulated in DECIMAL(38,6): exact for the 2-decimal values the
# report carries, and independent of the order in which Spark merges partial
# sums, so reruns and other partitionings give the same bits.
SUM_TYPE = DecimalType(38, 6)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round2(c) -> Column:
    """Round to 2 decimals, half to even on the scaled double.

    ``rint(x * 100) / 100`` is the rule of the report (0.125 -> 0.12,
    2.665 -> 2.66, 2.675 -> 2.68). Spark's ``round`` is half-up and
    would give 0.13 for 0.125.
    """
    return F.rint(_col(c) * F.lit(100.0)) / F.lit(100.0)


def exact_sum(c) -> Column:
    """Sum as DECIMAL(38,6) (see SUM_TYPE)."""
    return F.sum(_col(c).cast(SUM_TYPE))


def as_double(c) -> Column:
    return _col(c).cast("double")


def zero_if_null(c) -> Column:
    """Null -> 0."""
    return F.coalesce(_col(c), F.lit(0))


def safe_ratio(num, den) -> Column:
    """num / den as double; null when den is 0 or null."""
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))


# Cells that a table reader takes for missing.
MISSING_TEXTS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
                 "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def missing_text(c) -> Column:
    """Whether a cell is null or one of the texts that stand for a missing value."""
    return _col(c).isNull() | F.trim(_col(c)).isin(*MISSING_TEXTS)


def text_to_int(c) -> Column:
    """Text -> double -> integer, truncating toward zero.

    Missing values and text that is no finite number within range (``1,234``,
    ``Infinity``) become null instead of failing the job; callers report the
    latter.
    """
    number = F.when(~missing_text(c), _col(c).try_cast("double"))
    whole = F.when(number >= 0, F.floor(number.try_cast("decimal(38,6)"))).otherwise(F.ceil(number.try_cast("decimal(38,6)")))
    return whole.try_cast("long")
