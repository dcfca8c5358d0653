"""Fiscal-year comparison table (the report's core, Q1).

Input: ``(Date, Metric, Value)``, one row per metric per period. Output: the
seven report columns

    Date, Metric, Value, ytd, year_over_year, ytd_over_year, Previous_FY_Value

with these rules (traps T1-T5, T9):

* ``ytd``: running sum of ``Value`` per (Metric, fiscal year) ordered by date;
  for metrics whose name contains ``Session`` the running sum divided by the
  running row count (null rows count). A row whose own value is null gets 0;
  later rows continue. Rounded half-to-even to 2 decimals.
* ``year_over_year`` / ``ytd_over_year``: ``Value`` and ``ytd`` of the same
  metric in the same month one year earlier; 0 when absent. This is last
  year's value, not a growth rate.
* ``Previous_FY_Value``: sum (or, for ``Session`` metrics, mean over non-null
  values) of the metric over the previous fiscal year, 2 decimals, 0 if none.
* Nulls become 0 on output; rows with a null date or metric are dropped.

Two physical plans compute it; the grain of the data decides between them:

``join`` (parity, any input): a left self-join on (Metric, month, year - 1)
and an aggregate over the joined rows. When a metric has two rows in one
month, the join multiplies rows and the fiscal-year aggregate counts them
again (T4).

``window`` (unique grain only; a second row in a month is an error): one hash exchange on ``Metric`` and one
sort. The running sum is a ROWS frame per (Metric, fiscal year); a RANGE
frame over the previous fiscal year gives both its aggregate and, among its
at most 12 rows, the row of the same month (the prior-year value). On unique
grain a metric holds at most one row per month, so every window group is
bounded by the calendar, not by the data volume.

``auto`` checks the grain with one aggregate job and picks ``window`` when
it is unique, else ``join``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthend.functions.calendar import (FISCAL_START_MONTH, add_months_py,
                                         fiscal_year, fiscal_year_of,
                                         fiscal_year_start, month_index,
                                         next_month)
from monthend.functions.numeric import SUM_TYPE, as_double, exact_sum, round2
from monthend.operators.running import prefix_sums
from monthend.session import materialize

# Fixed value: metrics whose name contains this text (case-sensitive) are
# averaged; all others are summed.
MEAN_MARKER = "Session"

REPORT_COLUMNS = ["Date", "Metric", "Value", "ytd", "year_over_year",
                  "ytd_over_year", "Previous_FY_Value"]
CURRENT_COLUMNS = ["Date", "Metric", "Value", "Previous_FY_Value"]


def report_input(df: DataFrame, date: str = "Date", metric: str = "Metric",
                 value: str = "Value") -> DataFrame:
    """Normalise to (Date date, Metric string, Value double).

    Drops rows with a null metric (C3) or a null date (T9: they belong to no
    running sum). A NaN value is a missing one.
    """
    number = F.col(value).cast("double")
    return (df.select(F.col(date).cast("date").alias("Date"),
                      F.col(metric).cast("string").alias("Metric"),
                      F.when(~F.isnan(number), number).alias("Value"))
            .where(F.col("Date").isNotNull() & F.col("Metric").isNotNull()))


def _with_keys(df: DataFrame, start_month: int, marker: str) -> DataFrame:
    return df.withColumns({
        "fiscal_year": fiscal_year("Date", start_month),
        "_yr": F.year("Date"),
        "_mo": F.month("Date"),
        "_mi": month_index("Date"),
        "_mean": F.col("Metric").contains(marker),
    })


def _ytd(df: DataFrame) -> DataFrame:
    """F1-F4 on a frame that has the key columns."""
    w = (Window.partitionBy("Metric", "fiscal_year")
         .orderBy("Date", F.col("Value").asc_nulls_last())
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    run_sum = as_double(exact_sum("Value").over(w))
    run_rows = F.count(F.lit(1)).over(w)
    ytd = (F.when(F.col("Value").isNull(), F.lit(None).cast("double"))
           .when(F.col("_mean"), run_sum / run_rows)
           .otherwise(run_sum))
    return df.withColumn("ytd", round2(ytd))


def _fy_value(total: Column, n_values: Column) -> Column:
    """FY aggregate by metric kind (sum, or mean over non-null values)."""
    t = as_double(total)
    return round2(F.when(F.col("_mean"), F.try_divide(t, n_values)).otherwise(t))


def _finish(df: DataFrame) -> DataFrame:
    z = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    return df.select("Date", "Metric", z("Value").alias("Value"), z("ytd").alias("ytd"),
                     z("year_over_year").alias("year_over_year"),
                     z("ytd_over_year").alias("ytd_over_year"),
                     z("Previous_FY_Value").alias("Previous_FY_Value"))


def ytd_table(df: DataFrame, start_month: int = FISCAL_START_MONTH,
              marker: str = MEAN_MARKER) -> DataFrame:
    """F1-F4 only: (Date, Metric, Value, fiscal_year, ytd)."""
    return (_ytd(_with_keys(report_input(df), start_month, marker))
            .select("Date", "Metric", "Value", "fiscal_year", "ytd"))


def compare_join(df: DataFrame, start_month: int = FISCAL_START_MONTH,
                 marker: str = MEAN_MARKER) -> DataFrame:
    """Parity plan for any grain (D4 self-join, E6 after the join, D5).

    Identical rows (same Date, Metric, Value) are interchangeable, so the
    work runs on *groups of copies* ``(Date, Metric, Value, copies)``:

    * running sums per (Metric, fiscal year) over the groups give, for copy
      ``j`` of a group, ``ytd_j = before + j * Value`` and ``rows_j =
      rows_before + j`` -- a group of a million copies is one row here. They
      are range-partitioned prefix sums (``running.prefix_sums``), so not
      even many distinct values of one metric-year meet in one task;
    * a row counts once per row of the same metric-month a year earlier in
      the previous-FY aggregate (T4). That weight is the month's row count,
      so the aggregate needs totals per metric-month only, no pairs;
    * each group is paired with the groups of the same month a year earlier,
      a crowded month in cells of parts of both sides (``_paired``); the pair
      stands for ``copies x partner copies`` output rows;
    * finally each pair is expanded into its output rows. Pairs standing for
      more than EXPAND_CHUNK rows are cut into chunks that are spread over
      all tasks before expanding, so no task emits a hot group alone.
    """
    rows = report_input(df)
    g = _with_keys(rows.groupBy("Date", "Metric", "Value").agg(F.count(F.lit(1)).alias("_c")),
                   start_month, marker)
    order = [F.col("Date"), F.col("Value").asc_nulls_last()]
    sums = {"_p": F.col("Value").cast(SUM_TYPE) * F.col("_c"), "_np": F.col("_c")}
    # g feeds both sides of the join, the totals and the output; stored once
    g = materialize(prefix_sums(g, ["Metric", "fiscal_year"], order, sums))
    months = (g.groupBy("Metric", "fiscal_year", "_yr", "_mo", "_mean")
              .agg(F.sum("_c").alias("_rows"), F.sum(sums["_p"]).alias("_sum"),
                   F.sum(F.when(F.col("Value").isNotNull(), F.col("_c"))).alias("_n"),
                   F.count(F.lit(1)).alias("_groups")))
    same_month = Window.partitionBy("Metric", "_mo").orderBy("_yr").rangeBetween(-1, -1)
    weight = F.coalesce(F.sum("_rows").over(same_month), F.lit(1))
    fy = (months.withColumn("_w", weight).groupBy("Metric", "fiscal_year", "_mean")
          .agg(F.sum(F.col("_sum") * F.col("_w")).alias("_total"), F.sum(F.col("_n") * F.col("_w")).alias("_n"))
          .select("Metric", (F.col("fiscal_year") + 1).alias("fiscal_year"),
                  _fy_value(F.col("_total"), F.col("_n")).alias("Previous_FY_Value")))
    prior = g.select("Metric", (F.col("_yr") + 1).alias("_yr"), "_mo", F.col("Date").alias("_hd"),
                     F.col("Value").alias("_hv"), F.col("_c").alias("_hc"),
                     F.col("_p").alias("_hp"), F.col("_np").alias("_hnp"))
    parts = lambda n: F.ceil(F.coalesce(n, F.lit(1)) / PAIR_CELL).cast("int")
    crowded = materialize(
        months.withColumn("_before", F.sum("_groups").over(same_month))
        .select("Metric", "fiscal_year", "_yr", "_mo", parts(F.col("_groups")).alias("_own"), parts(F.col("_before")).alias("_prior"))
        .where((F.col("_own") > 1) | (F.col("_prior") > 1)))
    pairs = (_paired(g, prior, crowded, fy)
             .withColumn("_hc1", F.coalesce(F.col("_hc"), F.lit(1)).cast("long"))
             .withColumn("_w", F.col("_c") * F.col("_hc1")))
    out = _expand(pairs)
    j = F.floor(F.col("_t") / F.col("_hc1")) + 1
    k = F.col("_t") % F.col("_hc1") + 1
    return _finish(out.select(
        "Date", "Metric", "Value", "Previous_FY_Value",
        round2(_running(F.col("Value"), F.col("_p"), F.col("_np"), j)).alias("ytd"),
        F.col("_hv").alias("year_over_year"),
        round2(round2(_running(F.col("_hv"), F.col("_hp"), F.col("_hnp"), k))).alias("ytd_over_year")))


# Output rows one pair may emit inside its own task; larger pairs are split.
EXPAND_CHUNK = 100_000
# Groups of a metric-month that are paired in one place; more are cut into parts.
PAIR_CELL = 4096


def _paired(g: DataFrame, prior: DataFrame, crowded: DataFrame, fy: DataFrame) -> DataFrame:
    """Each group with those of its month a year earlier (null: none) and its previous fiscal year's value.

    A month of more than PAIR_CELL groups, or paired with one, is cut on both
    sides: a cell holds one part of each, and each group goes to the cells of
    its part. ``crowded`` has a row for each such month, with the number of
    parts of both sides; it meets the groups by a salt, so no task gets a
    month as a whole, whether or not Spark splits joins at run time.
    """
    n = int(g.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salts = F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    month = ["Metric", "_yr", "_mo"]
    spread = crowded.select(*month, "_own", "_prior", salts.alias("_salt"))

    def dealt(df: DataFrame, date: str, value: str) -> DataFrame:
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(date, value), F.lit(n)).cast("int"))
        return salted.join(spread, [*month, "_salt"], "left").withColumns(
            {k: F.coalesce(k, F.lit(1)) for k in ("_own", "_prior")})

    part = lambda count, *by: F.pmod(F.xxhash64(F.lit(1), *by), F.col(count)).cast("int")
    all_of = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    left = dealt(g, "Date", "Value").withColumn("_i", part("_own", "Date", "Value")).withColumn("_j", all_of("_prior"))
    right = (dealt(prior, "_hd", "_hv").withColumn("_j", part("_prior", "_hd", "_hv")).withColumn("_i", all_of("_own"))
             .drop("_salt", "_own", "_prior", "_hd"))
    paired = left.join(right, [*month, "_i", "_j"], "left")
    # a part that no group of the other side fell into pairs with nothing; the others hold the pairs
    paired = paired.where((F.col("_prior") == 1) | F.col("_hc").isNotNull())
    busy = crowded.select("Metric", "fiscal_year").distinct().withColumn("_busy", F.lit(n - 1))
    fy = fy.join(busy, ["Metric", "fiscal_year"], "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_busy", F.lit(0))))).drop("_busy")
    # groups of months that are not crowded stay together: a few cells a metric-year
    salt = F.when((F.col("_own") > 1) | (F.col("_prior") > 1), F.col("_salt")).otherwise(F.lit(0))
    return paired.withColumn("_salt", salt).join(fy, ["Metric", "fiscal_year", "_salt"], "left")


def _running(v: Column, before: Column, rows_before: Column, j: Column) -> Column:
    """ytd of copy ``j`` of a group: sum (or mean for Session metrics)."""
    s = as_double(before + v.cast(SUM_TYPE) * j.cast("long"))
    return (F.when(v.isNull(), F.lit(None).cast("double"))
            .when(F.col("_mean"), s / (rows_before + j))
            .otherwise(s))


def _expand(pairs: DataFrame) -> DataFrame:
    """One row per output row: ``_t`` in [0, _w)."""
    small = (pairs.where(F.col("_w") <= EXPAND_CHUNK)
             .withColumn("_t", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_w") - 1))))
    n = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunk = F.col("_chunk") * EXPAND_CHUNK
    big = (pairs.where(F.col("_w") > EXPAND_CHUNK)
           .withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"),
                                                      F.floor((F.col("_w") - 1) / EXPAND_CHUNK))))
           .repartition(n)
           .withColumn("_t", F.explode(F.sequence(chunk, F.least(chunk + EXPAND_CHUNK, F.col("_w")) - 1)))
           .drop("_chunk"))
    return small.unionByName(big)


def compare_window(df: DataFrame, start_month: int = FISCAL_START_MONTH,
                   marker: str = MEAN_MARKER) -> DataFrame:
    """Single-exchange, single-sort plan; exact only when (Metric, month) is unique.

    The previous fiscal year is one RANGE frame over ``fiscal_year``; it
    yields both the FY aggregate and, among its (at most 12) rows, the row of
    the same month -- the prior-year value. Its ordering is a prefix of the
    running-sum ordering, so Spark sorts once. The same sort shows a second
    row of a month, which ends the job with an error instead of a wrong row.
    """
    base = _with_keys(report_input(df), start_month, marker).repartition("Metric")
    by_date = Window.partitionBy("Metric", "fiscal_year").orderBy("Date", F.col("Value").asc_nulls_last())
    again = F.lag("_mi").over(by_date) == F.col("_mi")
    base = _ytd(base.withColumn("_again", again))
    prior_fy = Window.partitionBy("Metric").orderBy("fiscal_year").rangeBetween(-1, -1)
    months = F.collect_list(F.struct(F.col("_mo").alias("mo"), F.col("Value").alias("v"),
                                     F.col("ytd").alias("y"))).over(prior_fy)
    checked = F.when(F.col("_again"), F.raise_error(F.concat(
        F.lit("two rows in one month, use path='join': "), F.col("Metric")))).otherwise(F.col("Value"))
    out = base.select(
        "Date", "Metric", checked.cast("double").alias("Value"), "ytd", "_mo", "_mean",
        months.alias("_prev"),
        exact_sum("Value").over(prior_fy).alias("_total"),
        F.count("Value").over(prior_fy).alias("_n"))
    same = F.get(F.filter("_prev", lambda r: r["mo"] == F.col("_mo")), 0)
    return _finish(out.select(
        "Date", "Metric", "Value", "ytd",
        same["v"].alias("year_over_year"),
        round2(same["y"]).alias("ytd_over_year"),
        _fy_value(F.col("_total"), F.col("_n")).alias("Previous_FY_Value")))


def duplicate_months(df: DataFrame) -> DataFrame:
    """(Metric, month) groups holding more than one row, with their count."""
    return _month_rows(df).where(F.col("rows") > 1)


def _month_rows(df: DataFrame) -> DataFrame:
    return (report_input(df)
            .groupBy("Metric", month_index("Date").alias("month_index"))
            .agg(F.count(F.lit(1)).alias("rows")))


def has_unique_grain(df: DataFrame) -> bool:
    """True when no metric has two rows in a month (one aggregate job)."""
    return duplicate_months(df).isEmpty()


def compare_table(df: DataFrame, path: str = "auto",
                  start_month: int = FISCAL_START_MONTH,
                  marker: str = MEAN_MARKER) -> DataFrame:
    """Q1: the seven-column comparison table over the whole history."""
    if path == "auto":
        path = "window" if has_unique_grain(df) else "join"
    if path == "window":
        return compare_window(df, start_month, marker)
    if path == "join":
        return compare_join(df, start_month, marker)
    raise ValueError(f"unknown path {path!r}")


def _month_filter(df: DataFrame, month: dt.date) -> DataFrame:
    """Rows of one calendar month, written as a range so it can prune."""
    return df.where((F.col("Date") >= F.lit(month)) & (F.col("Date") < F.lit(next_month(month))))


def month_slice(df: DataFrame, month: dt.date, path: str = "auto",
                start_month: int = FISCAL_START_MONTH,
                marker: str = MEAN_MARKER) -> DataFrame:
    """Comparison rows of one month (Q2 core), computing only what it needs.

    On the window path the input is cut to the previous and current fiscal
    year up to ``month`` before the windows (a date range Catalyst pushes to
    the scan); a filter above a Window is otherwise not pushed below it. The
    cut is exact only when the grain is unique from two fiscal years back
    (earlier duplicates would inflate the previous FY, T4), which ``auto``
    checks on that range; otherwise the join path runs on the history from
    two fiscal years back, which is exact for any grain.
    """
    fy = fiscal_year_of(month, start_month)
    upper = next_month(month)
    d = F.col("Date")
    if path == "auto":
        check_from = fiscal_year_start(fy - 2, start_month)
        probe = report_input(df).where((d >= F.lit(check_from)) & (d < F.lit(upper)))
        path = "window" if has_unique_grain(probe) else "join"
    if path == "window":
        lower = fiscal_year_start(fy - 1, start_month)
        cut = report_input(df).where((d >= F.lit(lower)) & (d < F.lit(upper)))
        full = compare_window(cut, start_month, marker)
    else:
        # the month's rows depend on its fiscal year, the previous one, and
        # (through the partner counts that weight the previous FY) the one
        # before -- nothing earlier and nothing after the month
        lower = fiscal_year_start(fy - 2, start_month)
        cut = report_input(df).where((d >= F.lit(lower)) & (d < F.lit(upper)))
        full = compare_join(cut, start_month, marker)
    return _month_filter(full, month)


def analytics_slice(df: DataFrame, month: dt.date, **kw) -> DataFrame:
    """Q2: the target month, seven columns."""
    return month_slice(df, month, **kw).select(*REPORT_COLUMNS)


def current_slice(df: DataFrame, month: dt.date, **kw) -> DataFrame:
    """Q3: the running month, four columns."""
    return month_slice(df, month, **kw).select(*CURRENT_COLUMNS)


def sort_report(df: DataFrame) -> DataFrame:
    """The report order (Metric, Date)."""
    return df.orderBy("Metric", "Date")


__all__ = ["REPORT_COLUMNS", "CURRENT_COLUMNS", "MEAN_MARKER", "report_input",
           "ytd_table", "compare_join", "compare_window", "compare_table",
           "duplicate_months", "has_unique_grain", "month_slice",
           "analytics_slice", "current_slice", "sort_report", "add_months_py"]
