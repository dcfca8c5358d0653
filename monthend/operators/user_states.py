"""Mergeable user states: distinct users, views and sessions from days that were computed once.

A state row says of a user in an interval: first and last event, views, and
sessions counted as if nothing came before. Rows of disjoint intervals merge
exactly: views and sessions add up, less one session wherever a user's next
interval begins within the session gap of the last event before it. So
user-day rows give every longer period, and a run needs the raw events of its
new days only. A user costs a row a day, however many events there are.

Distinct users of a period are the users' first rows in it. As the optional
cheaper form, a day's users are held as a sketch (HyperLogLog, from Spark's
own functions) of fixed size, and the sketches of days are united; the error
is about 1.04 / sqrt(2 ** lg_k), 1.6 % at the default.

Null users count as one user, as in ``traffic_report``; days without events
have no rows; a repeated event adds to the views and to nothing else.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from monthend.functions.numeric import round2, safe_ratio
from monthend.operators.traffic import SESSION_GAP_MINUTES, in_date_range, session_buckets
from monthend.sources.versions import Version, VersionedTable

LG_K = 12
MEASURES = ["first_us", "last_us", "views", "sessions"]
STATE_SCHEMA = "first_us bigint, last_us bigint, views bigint, sessions bigint"


def daily_states(events: DataFrame, keys: list[str], ts: str = "ts", user: str = "user_id", view: str = "is_view",
                 gap_minutes: int = SESSION_GAP_MINUTES) -> DataFrame:
    """``keys, user, day`` and the measures of each user-day."""
    buckets = session_buckets(events, keys, ts, user, view, gap_minutes, period="day")
    return buckets.groupBy(*keys, user, F.col("_period").alias("day")).agg(
        F.min("_first_us").alias("first_us"), F.max("_last_us").alias("last_us"),
        F.sum("_views").alias("views"), F.sum("_start").alias("sessions"))


def _period(day: str, period: str) -> Column:
    if period == "all":
        return F.lit(None).cast("date")
    return F.trunc(day, period)


def _in_order(states: DataFrame, keys: list[str], user: str, period: str, gap_minutes: int) -> DataFrame:
    """Each row with its period, whether it is the user's first there, and whether it goes on with a session."""
    rows = states.withColumn("_period", _period("day", period))
    before = F.lag("last_us").over(Window.partitionBy(*keys, user, "_period").orderBy("first_us"))
    return rows.withColumns({
        "_new": before.isNull().cast("long"),
        "_goes_on": F.coalesce(F.col("first_us") - before < gap_minutes * 60 * 1_000_000, F.lit(False)).cast("long")})


def merge_states(states: DataFrame, keys: list[str], period: str, user: str = "user_id",
                 gap_minutes: int = SESSION_GAP_MINUTES) -> DataFrame:
    """State rows of longer intervals (``'week'``, ``'month'``, ``'year'``), with the period's first day as ``day``.

    The result is itself a table of states and can be merged further.
    """
    rows = _in_order(states, keys, user, period, gap_minutes)
    return rows.groupBy(*keys, user, F.col("_period").alias("day")).agg(
        F.min("first_us").alias("first_us"), F.max("last_us").alias("last_us"), F.sum("views").alias("views"),
        (F.sum("sessions") - F.sum("_goes_on")).alias("sessions"))


def report_from_states(states: DataFrame, keys: list[str], period: str = "month", user: str = "user_id",
                       gap_minutes: int = SESSION_GAP_MINUTES) -> DataFrame:
    """E1 from states, equal to ``traffic_report`` of the events: one shuffle of user-interval rows."""
    rows = _in_order(states, keys, user, period, gap_minutes)
    total = rows.groupBy(*keys, F.col("_period").alias("period_start")).agg(
        F.sum("_new").alias("users"), F.sum("views").alias("views"),
        (F.sum("sessions") - F.sum("_goes_on")).alias("sessions"))
    return total.withColumn("views_per_session", F.coalesce(round2(safe_ratio("views", "sessions")), F.lit(0.0)))


def daily_sketches(states: DataFrame, keys: list[str], user: str = "user_id", lg_k: int = LG_K) -> DataFrame:
    """``keys, day, sketch``: the users of a day in at most ``2 ** lg_k`` bytes or so."""
    return states.where(F.col(user).isNotNull()).groupBy(*keys, "day").agg(F.hll_sketch_agg(user, lg_k).alias("sketch"))


def users_from_sketches(sketches: DataFrame, keys: list[str], period: str = "month") -> DataFrame:
    """``keys, period_start, users``: estimates from the united sketches of days."""
    return sketches.groupBy(*keys, _period("day", period).alias("period_start")).agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("users"))


def day_number(day: dt.date) -> int:
    return day.year * 10000 + day.month * 100 + day.day


class TrafficStates:
    """User-day states on disk, a partition per day; the commit records up to when events were loaded."""

    def __init__(self, spark: SparkSession, root: str, keys: dict[str, str], user: str = "user_id", user_type: str = "bigint"):
        self.spark, self.keys, self.user = spark, list(keys), user
        columns = ", ".join([*(f"{k} {t}" for k, t in keys.items()), f"{user} {user_type}", "day date", STATE_SCHEMA])
        self.table = VersionedTable(spark, root, columns, ["day_number"])

    def loaded_to(self) -> dt.date | None:
        to = self.table.version().properties.get("loaded_to")
        return None if to is None else dt.date.fromisoformat(to)

    def load(self, events: DataFrame, first: dt.date, last: dt.date, **columns) -> Version:
        """Computes the days from ``first`` to ``last`` (late or corrected events too) and replaces them."""
        base = self.table.version()
        states = daily_states(events.where(in_date_range(columns.get("ts", "ts"), first, last)), self.keys, user=self.user, **columns)
        number = (F.year("day") * 10000 + F.month("day") * 100 + F.day("day")).cast("int")
        written = self.table.write_data(states.withColumn("day_number", number).repartitionByRange("day_number", *self.keys, self.user))
        days = [first + dt.timedelta(days=i) for i in range((last - first).days + 1)]
        to = max(filter(None, [base.properties.get("loaded_to"), last.isoformat()]))
        return self.table.commit(base, {**{f"day_number={day_number(d)}": None for d in days}, **written}, {"loaded_to": to})

    def advance(self, events: DataFrame, as_of: dt.date, first: dt.date, **columns) -> Version:
        """A regular run: reads the events since the last one (its own last day again, which was not over).

        ``first`` is where the very first run begins.
        """
        return self.load(events, self.loaded_to() or first, as_of, **columns)

    def read(self, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
        """The states of a range of days; only their partitions are named to Spark."""
        inside = lambda key: ((first is None or int(key.partition("=")[2]) >= day_number(first))
                              and (last is None or int(key.partition("=")[2]) <= day_number(last)))
        return self.table.read(keep=inside).drop("day_number")

    def report(self, period: str = "month", first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
        return report_from_states(self.read(first, last), self.keys, period, self.user)
