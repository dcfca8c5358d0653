"""Calendar expressions: fiscal year, month arithmetic, period ends.

All functions return Columns (JVM-side, inside whole-stage codegen) except
the few that resolve run parameters on the driver (``report_months``).
``as_of`` is always an argument, never ``current_date()`` inside a plan, so
results can be reproduced.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the fiscal year starts in August (month 8); a date in
# August 2024 belongs to fiscal year 2024, a date in March 2026 to 2025.
FISCAL_START_MONTH = 8


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _date_lit(d) -> Column:
    if isinstance(d, Column):
        return d
    if isinstance(d, str):
        d = dt.date.fromisoformat(d)
    return F.lit(d)


def fiscal_year(date, start_month: int = FISCAL_START_MONTH) -> Column:
    """K1: year when month >= start_month, else year - 1."""
    d = _col(date)
    return (F.year(d) - F.when(F.month(d) >= start_month, 0).otherwise(1)).cast("int")


def fiscal_year_start(fy: int, start_month: int = FISCAL_START_MONTH) -> dt.date:
    """First day of fiscal year ``fy`` (driver-side parameter)."""
    return dt.date(fy, start_month, 1)


def fiscal_year_of(d: dt.date, start_month: int = FISCAL_START_MONTH) -> int:
    return d.year if d.month >= start_month else d.year - 1


def month_index(date) -> Column:
    """Months since year 0: consecutive calendar months differ by 1."""
    d = _col(date)
    return (F.year(d) * 12 + F.month(d) - 1).cast("int")


def month_start(date) -> Column:
    return F.trunc(_col(date), "month")


def last_day_of(year, month) -> Column:
    """Last day of a (year, month) given as columns or ints."""
    y = F.lit(year) if isinstance(year, int) else _col(year)
    m = F.lit(month) if isinstance(month, int) else _col(month)
    return F.last_day(F.make_date(y, m, F.lit(1)))


def period_end(month, as_of) -> Column:
    """K2: the month end, or ``as_of`` for the running month.

    ``least(last_day(month), as_of)`` equals the reference for every month up
    to the running one; a future month would also be cut at ``as_of``.
    """
    return F.least(F.last_day(_col(month)), _date_lit(as_of))


def previous_month(as_of) -> Column:
    """K3: first day of the month before ``as_of``."""
    return F.add_months(F.trunc(_date_lit(as_of), "month"), -1)


def two_digit_year(yy) -> Column:
    """Two-digit year text or number -> 2000 + yy."""
    return (F.lit(2000) + _col(yy).cast("int")).cast("int")


def next_month(d: dt.date) -> dt.date:
    return dt.date(d.year + d.month // 12, d.month % 12 + 1, 1)


def add_months_py(d: dt.date, n: int) -> dt.date:
    k = d.year * 12 + d.month - 1 + n
    return dt.date(k // 12, k % 12 + 1, 1)


def reload_window(spark: SparkSession, as_of) -> DataFrame:
    """K4: the two months a regular run reloads: previous and current.

    Columns: month_start, period_end.
    """
    a = _date_lit(as_of)
    return (spark.range(1)
            .select(F.explode(F.array(previous_month(a), F.trunc(a, "month")))
                    .alias("month_start"))
            .withColumn("period_end", period_end("month_start", a)))


def month_calendar(spark: SparkSession, start, as_of) -> DataFrame:
    """K5: every month from ``start`` to ``as_of`` inclusive, in one job.

    ``start`` may be a date or a Column from a one-row frame; columns:
    month_start, period_end, fiscal_year.
    """
    a = _date_lit(as_of)
    s = F.trunc(_date_lit(start), "month")
    return (spark.range(1)
            .select(F.explode(F.sequence(s, F.trunc(a, "month"),
                                         F.expr("INTERVAL 1 MONTH"))).alias("month_start"))
            .withColumn("period_end", period_end("month_start", a))
            .withColumn("fiscal_year", fiscal_year("month_start")))


def calendar_over(df: DataFrame, start_col: str, as_of) -> DataFrame:
    """K5 with the start taken from data: ``df`` has one row per start.

    Used when the first month comes from an aggregate (e.g. the first order).
    """
    a = _date_lit(as_of)
    return (df.select(F.explode(F.sequence(F.trunc(F.col(start_col), "month"),
                                           F.trunc(a, "month"),
                                           F.expr("INTERVAL 1 MONTH"))).alias("month_start"))
            .withColumn("period_end", period_end("month_start", a))
            .withColumn("fiscal_year", fiscal_year("month_start")))


def report_months(as_of: dt.date, target_month: str | None = None) -> tuple[dt.date, dt.date]:
    """K6: (analytics month, current month) as first days.

    ``target_month=None`` is the reference's ``auto`` mode: the month before
    ``as_of``. A ``'YYYY-MM'`` string is its ``manual`` mode. The current
    month is always the month of ``as_of``.
    """
    if isinstance(as_of, str):
        as_of = dt.date.fromisoformat(as_of)
    current = as_of.replace(day=1)
    if target_month:
        y, m = (int(x) for x in target_month.split("-"))
        analytics = dt.date(y, m, 1)
    else:
        analytics = add_months_py(current, -1)
    return analytics, current


def report_month_columns(as_of, target_month) -> tuple[Column, Column]:
    """K6 as columns: (analytics month, current month) of each row.

    A null ``target_month`` is the automatic mode, ``'YYYY-MM'`` the manual one.
    """
    current = F.trunc(as_of, "month")
    chosen = F.try_to_date(F.concat(target_month, F.lit("-01")), "yyyy-MM-dd")
    return F.coalesce(chosen, F.add_months(current, -1)), current
