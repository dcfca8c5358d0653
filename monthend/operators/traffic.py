"""Traffic metrics re-aimed on an event table.

The reference asks a web-analytics API for users, page views and views per
session of a site over a date range, and a video API for views by traffic
source. Here the same numbers are computed from raw events
``(ts, user_id, is_view, <keys>...)``.

Sessions: a user's session ends after SESSION_GAP_MINUTES without events
(a gap of exactly that length starts a new one, as ``session_window`` does).
Every period stands alone, as a report asked for that period alone: a session
that runs on into the next period counts in both, and no number depends on
which other periods a run computes. They are found without a per-user sort
of raw events: events are first pre-aggregated into
(keys, user, period, 30-minute bucket) rows -- a map-side combine, so one very
active user costs no more than one row per bucket. Inside a bucket no gap
can reach 30 minutes, so only the first event of a bucket can open a
session, and that is decided by comparing it with the last event of the
user's previous non-empty bucket. That window holds at most 48 rows per
user-day, whatever the event volume.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from monthend.functions.numeric import round2, safe_ratio
from monthend.operators.asof import SMALL, as_of, overlaps

# Design choice (the reference only names the metric): inactivity gap that
# ends a session, in minutes.
SESSION_GAP_MINUTES = 30
# Fixed value: the traffic source that counts as advertising.
ADS_SOURCE = "ADVERTISING"


def epoch_micros(df: DataFrame, ts: str) -> Column:
    """Microseconds since 1970-01-01 for TIMESTAMP or TIMESTAMP_NTZ columns."""
    if isinstance(df.schema[ts].dataType, TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{ts}`)")
    return F.unix_micros(F.col(ts))


def period_start(ts: Column, period: str) -> Column:
    """Period of a timestamp: ``'day'`` -> its date, ``'month'`` -> first day."""
    if period == "day":
        return F.to_date(ts)
    if period == "month":
        return F.trunc(F.to_date(ts), "month")
    raise ValueError(f"unknown period {period!r}")


def in_date_range(ts: str, start, end) -> Column:
    """Inclusive date range on a timestamp, written as a half-open
    timestamp range so Parquet can skip row groups."""
    start = dt.date.fromisoformat(start) if isinstance(start, str) else start
    end = dt.date.fromisoformat(end) if isinstance(end, str) else end
    # text -> TIMESTAMP_NTZ does not depend on the session time zone
    s = F.lit(f"{start.isoformat()} 00:00:00").cast("timestamp_ntz")
    e = F.lit(f"{(end + dt.timedelta(days=1)).isoformat()} 00:00:00").cast("timestamp_ntz")
    return (F.col(ts) >= s) & (F.col(ts) < e)


def host_equals(host: str, value: str | Column) -> Column:
    """Exact (case-sensitive) filter on the whole host."""
    return F.col(host) == (F.lit(value) if isinstance(value, str) else value)


def session_buckets(events: DataFrame, keys: list[str], ts: str = "ts",
                    user: str = "user_id", view: str = "is_view",
                    gap_minutes: int = SESSION_GAP_MINUTES, period: str = "month") -> DataFrame:
    """(keys, user, bucket) rows with views, period and two flags.

    ``_start``: the bucket's first event opens a session of its period.
    ``_new_user``: the bucket is the user's first in its period, so summing it
    counts distinct users without a separate distinct aggregation. The period
    is part of the bucket, as in time zones off the half hour a bucket can lie
    on both sides of midnight.
    """
    gap = gap_minutes * 60 * 1_000_000
    us = epoch_micros(events, ts)
    b = (events.withColumns({"_us": us, "_period": period_start(F.col(ts), period)})
         .groupBy(*keys, user, "_period", F.floor(F.col("_us") / gap).alias("_bucket"))
         .agg(F.min("_us").alias("_first_us"), F.max("_us").alias("_last_us"),
              F.sum(F.col(view).cast("long")).alias("_views")))
    prev_last = F.lag("_last_us").over(Window.partitionBy(*keys, user, "_period").orderBy("_bucket"))
    return b.withColumns({
        "_start": (prev_last.isNull() | (F.col("_first_us") - prev_last >= gap)).cast("long"),
        "_new_user": prev_last.isNull().cast("long"),
    })


def traffic_report(events: DataFrame, keys: list[str], period: str = "month",
                   ts: str = "ts", user: str = "user_id", view: str = "is_view") -> DataFrame:
    """Per (keys, period): users, views, sessions, views per session.

    users = distinct users with an event in the period; views = view events;
    views_per_session = views / sessions rounded half-to-even to 2 decimals,
    0 when there is no session. All three come from the bucket rows: no
    distinct aggregation and no second pass over the events.

    Rounding (T1): the report's rule ``rint(x * 100) / 100`` is used. The
    reference rounded this one value with exact-decimal rounding instead, so
    for a ratio that is exactly a half cent in decimal (e.g. 2.675) the last
    digit can differ (2.68 here, 2.67 there).
    """
    b = session_buckets(events, keys, ts, user, view, period=period)
    agg = (b.groupBy(*keys, F.col("_period").alias("period_start"))
           .agg(F.sum("_new_user").alias("users"),
                F.sum("_views").alias("views"),
                F.sum("_start").alias("sessions")))
    return agg.withColumn("views_per_session",
                          F.coalesce(round2(safe_ratio("views", "sessions")), F.lit(0.0)))


def source_views(sources: DataFrame, period: str | None = None, ts: str = "ts",
                 source: str = "source", views: str = "views") -> DataFrame:
    """A6 (no period) / A6b (``'day'``) / monthly: views by traffic source."""
    keys = [F.col(source).alias("source")]
    if period:
        keys.append(period_start(F.col(ts), period).alias(period))
    return sources.groupBy(*keys).agg(F.sum(views).cast("long").alias("views"))


def video_totals(by_source: DataFrame, keys: list[str], ads_source: str = ADS_SOURCE) -> DataFrame:
    """Total views, advertising views and organic = total - ads."""
    return (by_source.groupBy(*keys)
            .agg(F.sum("views").cast("long").alias("total_views"),
                 F.coalesce(F.sum(F.when(F.col("source") == ads_source, F.col("views"))),
                            F.lit(0)).cast("long").alias("ads_views"))
            .withColumn("organic_views", F.col("total_views") - F.col("ads_views")))


def cutover_table(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Effective-dated source table (name, scheme, valid_from, valid_to, site filter)."""
    return spark.createDataFrame(
        rows, "source_name string, scheme string, valid_from date, valid_to date, site_filter string")


def checked_cutover(cutover: DataFrame) -> DataFrame:
    """The table, failing when an event could match two of its rows.

    Two rows can meet one event if they share a scheme and overlapping dates
    and do not filter on different sites; a sorted sweep finds them.
    """
    clash = overlaps(cutover, ["scheme"], "valid_from", "valid_to", "source_name", "site_filter").first()
    if clash:
        raise ValueError(f"sources {clash.name!r} and {clash.other!r} overlap in time")
    return cutover


def choose_source(events: DataFrame, cutover: DataFrame, period_end: str = "period_end",
                  scheme: str = "scheme", site: str = "site", small: int = SMALL) -> DataFrame:
    """Keep each event only from the source valid at its period's end.

    A period uses the row with ``valid_from <= period_end < valid_to`` (the
    period *end* decides, so a month that ends after the cutover uses the new
    source for all of it). A non-null ``site_filter`` adds an exact filter on
    ``site`` (a column of whole hosts, or of whatever the table names). Rows
    of one scheme whose dates overlap would count events twice and are refused.

    A table of at most ``small`` rows meets the events in one join, which the
    optimizer broadcasts. A larger one is looked up by an as-of join for the
    distinct (scheme, site, period end) of the events, once for rows with a
    site and once for those without; as no two rows overlap, at most one fits.
    """
    c = checked_cutover(cutover)
    if c.limit(small + 1).count() <= small:
        cond = ((events[scheme] == c.scheme)
                & (events[period_end] >= c.valid_from) & (events[period_end] < c.valid_to)
                & (c.site_filter.isNull() | host_equals(site, c.site_filter)))
        return events.join(c, cond, "inner").drop(c.scheme).drop("valid_from", "valid_to", "site_filter")
    asked = events.select(F.col(scheme).alias("_scheme"), F.col(site).alias("_site"), F.col(period_end).alias("_end")).distinct()
    rows = c.where("valid_from < valid_to").select(F.col("scheme").alias("_scheme"), F.col("site_filter").alias("_site"),
                                                   "valid_from", "valid_to", "source_name")
    take = ["valid_to", "source_name"]
    found = as_of(asked, rows.where("_site is not null"), ["_scheme", "_site"], "_end", "valid_from", take).unionByName(
        as_of(asked, rows.where("_site is null").drop("_site"), ["_scheme"], "_end", "valid_from", take))
    chosen = found.where("_end < valid_to").select("_scheme", "_site", "_end", "source_name")
    met = ((events[scheme] == F.col("_scheme")) & events[site].eqNullSafe(F.col("_site"))
           & (events[period_end] == F.col("_end")))
    return events.join(chosen, met).drop("_site", "_end", "_scheme")
