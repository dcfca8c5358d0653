"""Monthly traffic load (Q4) and historical backfill (Q5).

The reference loops over months and, per month, deletes the month, calls
four remote reports and inserts twelve numbers. Here one job computes every
month of the window at once: events are tagged with their month, the
per-(property, month) metrics and per-month video totals are aggregated,
missing combinations become zeros (T6: an empty report is stored as 0),
the wide result is unpivoted to named metric rows, mapped to glossary ids,
and the month slices are replaced.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthend.functions.calendar import add_months_py, period_end
from monthend.operators.lookup import names_to_ids
from monthend.operators.mutate import replace_months
from monthend.operators.reshape import wide_to_long
from monthend.operators.traffic import (ADS_SOURCE, choose_source, in_date_range,
                                        source_views, traffic_report, video_totals)
from monthend.plans.load_report import LoadReport, names_to_ids_counted
from monthend.session import materialize
from monthend.sources.store import FactStore

# Metric name suffixes per property and the video metric names.
PROPERTY_MEASURES = {"users": "Total Users", "views": "Views",
                     "views_per_session": "Views Per Session"}
VIDEO_MEASURES = {"ads_views": "Video Advertisement Views",
                  "organic_views": "Video Organic Views",
                  "total_views": "Video Total Views"}


def _as_date(d) -> dt.date:
    return dt.date.fromisoformat(d) if isinstance(d, str) else d


def reload_months(as_of) -> list[dt.date]:
    """K4: previous and current month of ``as_of`` (first days)."""
    cur = _as_date(as_of).replace(day=1)
    return [add_months_py(cur, -1), cur]


def backfill_months(start, as_of) -> list[dt.date]:
    """K5 on the driver: every month from ``start`` to ``as_of``, inclusive.

    A run parameter (bounded by the calendar), used to build literal grids.
    """
    s, a = _as_date(start).replace(day=1), _as_date(as_of).replace(day=1)
    out = []
    while s <= a:
        out.append(s)
        s = add_months_py(s, 1)
    return out


def _month_grid(df: DataFrame, months: list[dt.date]) -> DataFrame:
    """Each row of ``df`` once per month (a per-row explode, no cross join)."""
    return df.withColumn("period_start", F.explode(F.array(*[F.lit(m) for m in months])))


def traffic_metric_rows(events: DataFrame, sources: DataFrame, properties: DataFrame,
                        months: list[dt.date], as_of, ads_source: str = ADS_SOURCE,
                        daily_sources: bool = False,
                        cutover: tuple[str, DataFrame] | None = None) -> DataFrame:
    """Named metric rows (fecha, Metric, valor) for ``months`` up to ``as_of``.

    ``events``: (ts, user_id, is_view, property); ``sources``: (ts, source,
    views); ``properties``: the catalogue (property). ``daily_sources``
    aggregates the video views by (source, day) first, as the backfill does;
    the monthly totals are the same.

    ``cutover=(name, table)`` adds property ``name`` whose events, per month,
    come from the source valid at that month's end (D6; ``events`` then also
    needs ``scheme`` and ``site``).
    """
    as_of = _as_date(as_of)
    first = months[0]
    cols = ["ts", "user_id", "is_view", "property"]
    ev = events.where(in_date_range("ts", first, as_of))
    props = properties.select("property").distinct()
    if cutover is not None:
        name, table = cutover
        pe = period_end(F.trunc(F.to_date("ts"), "month"), as_of).alias("period_end")
        chosen = (choose_source(ev.select("*", pe), table)
                  .withColumn("property", F.lit(name)).select(*cols))
        ev = ev.select(*cols).unionByName(chosen)
        props = props.unionByName(props.sparkSession.range(1).select(F.lit(name).alias("property")))
    rep = traffic_report(ev, ["property"], period="month")
    grid = _month_grid(props, months)
    prop = (grid.join(rep, ["property", "period_start"], "left")
            .select("property", "period_start",
                    *[F.coalesce(F.col(c), F.lit(0)).cast("double").alias(c) for c in PROPERTY_MEASURES]))
    prop_rows = (wide_to_long(prop, ["property", "period_start"], PROPERTY_MEASURES)
                 .select("period_start", F.concat_ws(" ", "property", "Metric").alias("Metric"), "valor"))

    src = sources.where(in_date_range("ts", first, as_of))
    if daily_sources:
        by_source = (source_views(src, period="day")
                     .withColumn("period_start", F.trunc("day", "month")))
    else:
        by_source = source_views(src, period="month").withColumnRenamed("month", "period_start")
    vid = video_totals(by_source, ["period_start"], ads_source)
    vgrid = (_month_grid(vid.sparkSession.range(1).select(), months)
             .join(vid, "period_start", "left")
             .select("period_start",
                     *[F.coalesce(F.col(c), F.lit(0)).cast("double").alias(c) for c in VIDEO_MEASURES]))
    vid_rows = wide_to_long(vgrid, ["period_start"], VIDEO_MEASURES)

    return (prop_rows.unionByName(vid_rows)
            .select(period_end("period_start", as_of).alias("fecha"), "Metric", "valor"))


def glossary_properties(glossary: DataFrame) -> DataFrame:
    """The properties whose metrics the glossary names: no scan of the events for a list of sites."""
    others = set(VIDEO_MEASURES.values())
    found = F.lit(None).cast("string")
    for label in PROPERTY_MEASURES.values():
        own = F.col("nombre").endswith(f" {label}")
        found = F.coalesce(found, F.when(own, F.substring("nombre", F.lit(1), F.length("nombre") - len(label) - 1)))
    return (glossary.where(~F.col("nombre").isin(*others)).select(found.alias("property"))
            .where(F.col("property").isNotNull()).distinct())


def traffic_metric_names(properties: DataFrame) -> DataFrame:
    """Every metric name the traffic load can produce for a property catalogue."""
    labels = F.array(*[F.lit(v) for v in PROPERTY_MEASURES.values()])
    prop = (properties.select("property", F.explode(labels).alias("_label"))
            .select(F.concat_ws(" ", "property", "_label").alias("Metric")))
    video = properties.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(v) for v in VIDEO_MEASURES.values()])).alias("Metric"))
    return prop.unionByName(video).distinct()


def monthly_load(target: DataFrame, glossary: DataFrame, events: DataFrame, sources: DataFrame,
                 properties: DataFrame, as_of, **kw) -> DataFrame:
    """Q4: reload the previous and the current month into ``target``.

    Returns the new fact table; only the loader's metric ids in those two
    months change. Names missing from the glossary are skipped (see
    ``lookup.missing_names`` for the report).
    """
    rows = traffic_metric_rows(events, sources, properties, reload_months(as_of), as_of, **kw)
    # the update batch is small but costly (it aggregates the events); the
    # month slice reads it three times, so compute it once
    updates = materialize(names_to_ids(rows, glossary).select("fecha", "metrica", "valor"))
    return replace_months(target, updates)


def backfill(target: DataFrame, glossary: DataFrame, events: DataFrame, sources: DataFrame,
             properties: DataFrame, start, as_of, **kw) -> DataFrame:
    """Q5: reload every month from ``start`` to ``as_of`` in one job."""
    rows = traffic_metric_rows(events, sources, properties, backfill_months(start, as_of), as_of,
                               daily_sources=True, **kw)
    updates = materialize(names_to_ids(rows, glossary).select("fecha", "metrica", "valor"))
    return replace_months(target, updates)


def _loaded_rows(report: LoadReport, events: DataFrame, sources: DataFrame, glossary: DataFrame, properties: DataFrame,
                 months: list[dt.date], as_of: dt.date, **kw) -> DataFrame:
    """The fact rows of some months, with the counters of the load attached."""
    inside = in_date_range("ts", months[0], as_of)
    events = report.watch("events", events.where(inside), without_property=F.col("property").isNull(),
                          without_user=F.col("user_id").isNull())
    sources = report.watch("sources", sources.where(inside), without_source=F.col("source").isNull())
    rows = traffic_metric_rows(events, sources, properties, months, as_of, **kw)
    return names_to_ids_counted(rows, glossary, report).select("fecha", "metrica", "valor")


def monthly_load_store(store: FactStore, glossary: DataFrame, events: DataFrame, sources: DataFrame,
                       properties: DataFrame, as_of, **kw) -> dict:
    """Q4 on disk; its counters, which the commit holds too (property ``load``)."""
    report = LoadReport()
    rows = _loaded_rows(report, events, sources, glossary, properties, reload_months(as_of), _as_date(as_of), **kw)
    store.replace_months(rows, properties=lambda: {"load": report.result()})
    return report.result()


def backfill_store(store: FactStore, glossary: DataFrame, events: DataFrame, sources: DataFrame,
                   properties: DataFrame, start, as_of, months_per_commit: int = 12, run: str | None = None,
                   **kw) -> list[dt.date]:
    """Q5 on disk, in commits of some months each; the months this call computed.

    Each commit records the months done so far under the run's name (default:
    its range), in the same switch that brings in their rows. A run that died
    is called again with the same name and skips the months it finished. The
    rows are those of one whole backfill: every month stands alone.
    """
    as_of, run = _as_date(as_of), run or f"{_as_date(start)}..{_as_date(as_of)}"
    ledger = store.version().properties.get("backfill", {})
    finished = set(ledger["months"]) if ledger.get("run") == run else set()
    pending = [m for m in backfill_months(start, as_of) if m.isoformat() not in finished]
    for i in range(0, len(pending), months_per_commit):
        some = pending[i:i + months_per_commit]
        until = min(as_of, add_months_py(some[-1], 1) - dt.timedelta(days=1))
        report = LoadReport()
        rows = _loaded_rows(report, events, sources, glossary, properties, some, until, daily_sources=True, **kw)
        finished |= {m.isoformat() for m in some}
        done = sorted(finished)
        store.replace_months(rows, properties=lambda done=done, report=report: {
            "backfill": {"run": run, "months": done}, "load": report.result()})
    return pending
