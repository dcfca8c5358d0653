"""

Every query reads the given tables (``<sf_dir>/<name>.parquet``) through the
derivations in ``monthend.sources.testdata`` and runs over them whole. The
oracle SQL computes the same result independently in DuckDB.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthend.functions.calendar import calendar_over, fiscal_year, report_month_columns
from monthend.operators import asof as AO
from monthend.operators import compare as C
from monthend.operators import lookup as L
from monthend.operators import media as M
from monthend.operators import mutate as U
from monthend.operators import reshape as R
from monthend.operators import traffic as T
from monthend.operators import user_states as US
from monthend.plans import media_load as ML
from monthend.plans import monthly_load as Q
from monthend.plans import report as RP
from monthend.plans import upkeep as UK
from monthend.session import materialize, scratch_path
from monthend.sources import files as FS
from monthend.sources import testdata as TD
from monthend.sources.store import FactStore, published

SF_SMOKE = "/root/testdata/sf0.001"

# The training-data operators and their pipeline are optional parts of a checkout.
EXTRA_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
EXTRA_ORACLES: dict[str, str] = {}
try:
    import corpus_pipeline as _pipeline
    from monthend.llm import queries as _llm
except ImportError:
    pass
else:
    EXTRA_QUERIES |= _llm.QUERIES | {"pipeline": _pipeline.run}
    EXTRA_ORACLES |= _llm.ORACLES
    if _pipeline.ORACLE_SQL:
        EXTRA_ORACLES["pipeline"] = _pipeline.ORACLE_SQL

# Fixed run parameters of the registered queries.
ORDERS_AS_OF = dt.date(2001, 8, 1)          # as-of date of the order history
ANALYTICS_MONTH = dt.date(2001, 7, 1)       # Analytics tab month
CURRENT_MONTH = dt.date(2001, 8, 1)         # Current Month tab month
EVENTS_AS_OF = dt.date(2024, 1, 20)         # as-of date of the event stream
BACKFILL_START = dt.date(2023, 11, 1)       # first month of the backfill
PREVIOUS_RUN = dt.date(2024, 1, 10)         # as-of date of the run a reload replaces
EVENTS_RANGE = (dt.date(2024, 1, 5), dt.date(2024, 1, 20))  # a report range that leaves events out
CUTOVER_ROWS = [                            # effective-dated traffic source
    ("old", "http", dt.date(1900, 1, 1), dt.date(2024, 1, 15), "blog"),
    ("new", "https", dt.date(2024, 1, 15), dt.date(9999, 12, 31), None),
]
UNREGISTERED_PROPERTY = "org"               # left out of the traffic glossary


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the Analytics tab (Q2) for July 2001 on sf0.001."""
    return _analytics_slice(spark, SF_SMOKE)


# --------------------------------------------------------------------------
# query builders


def _seg_report_input(spark, sf):
    fact, glossary = TD.segments_fact(spark, sf)
    return L.ids_to_names(fact, glossary)


def _analytics_slice(spark, sf):
    return C.analytics_slice(_seg_report_input(spark, sf), ANALYTICS_MONTH)


def _current_slice(spark, sf):
    return C.current_slice(_seg_report_input(spark, sf), CURRENT_MONTH)


def _fiscal_year(spark, sf):
    o = TD.table(spark, sf, "orders")
    return o.select("o_orderkey", F.to_date("o_orderdate").alias("order_date"),
                    fiscal_year(F.to_date("o_orderdate")).alias("fiscal_year"))


def _month_calendar(spark, sf):
    first = TD.table(spark, sf, "orders").agg(F.min(F.to_date("o_orderdate")).alias("first"))
    return calendar_over(first, "first", ORDERS_AS_OF)


def _compare_duplicates(spark, sf):
    return C.compare_table(TD.daily_customers_long(spark, sf))


def _traffic_inputs(spark, sf):
    return (TD.traffic_events(spark, sf), TD.traffic_sources(spark, sf),
            TD.page_properties(spark, sf))


def _traffic_rows(spark, sf, months, daily=False, as_of=EVENTS_AS_OF):
    ev, src, props = _traffic_inputs(spark, sf)
    return Q.traffic_metric_rows(ev, src, props, months, as_of,
                                 ads_source=TD.ADS_SOURCE, daily_sources=daily)


def _traffic_glossary(spark, sf):
    names = Q.traffic_metric_names(TD.page_properties(spark, sf))
    registered = names.where(~F.col("Metric").startswith(UNREGISTERED_PROPERTY + " "))
    return L.build_glossary(registered)


def _missing_metrics(spark, sf):
    rows = _traffic_rows(spark, sf, Q.reload_months(EVENTS_AS_OF))
    return L.missing_names(rows, _traffic_glossary(spark, sf))


def _backfill(spark, sf):
    rows = _traffic_rows(spark, sf, Q.backfill_months(BACKFILL_START, EVENTS_AS_OF), daily=True)
    return L.names_to_ids(rows, _traffic_glossary(spark, sf)).select("fecha", "metrica", "valor")


def _monthly_load(spark, sf):
    """Q4: the table after an earlier run is reloaded by the regular run."""
    g = _traffic_glossary(spark, sf)
    earlier = _traffic_rows(spark, sf, Q.backfill_months(BACKFILL_START, PREVIOUS_RUN), as_of=PREVIOUS_RUN)
    target = materialize(L.names_to_ids(earlier, g).select("fecha", "metrica", "valor"))
    ev, src, props = _traffic_inputs(spark, sf)
    return Q.monthly_load(target, g, ev, src, props, EVENTS_AS_OF, ads_source=TD.ADS_SOURCE)


def _media_load(spark, sf):
    """Q6: mention files upserted into the table the history upload left."""
    target = materialize(_history_unpivot(spark, sf))
    updates = materialize(ML.mention_updates(TD.media_rows(spark, sf), ML.media_glossary_rows(spark)))
    return U.upsert(target, updates)


def _traffic_sources_range(spark, sf):
    """A6 + C6: views by source over an inclusive date range."""
    src = TD.traffic_sources(spark, sf)
    return T.source_views(src.where(T.in_date_range("ts", *EVENTS_RANGE)))


def _video_totals(spark, sf):
    """E2 + E3: total, advertising and organic views per month."""
    by_source = T.source_views(TD.traffic_sources(spark, sf), period="month")
    return T.video_totals(by_source, ["month"], ads_source=TD.ADS_SOURCE)


def _source_cutover(spark, sf):
    ev = TD.traffic_events(spark, sf).withColumn("period_end", F.to_date("ts"))
    chosen = T.choose_source(ev, T.cutover_table(spark, CUTOVER_ROWS))
    return T.traffic_report(chosen, ["source_name"], period="day")


def _replace_months(spark, sf):
    fact, glossary = TD.segments_fact(spark, sf)
    return U.replace_months(fact, TD.segment_updates(fact, glossary))


def _upsert(spark, sf):
    fact, glossary = TD.segments_fact(spark, sf)
    return U.upsert(fact, TD.segment_updates(fact, glossary))


def _insert_ignore(spark, sf):
    return U.insert_ignore(TD.segments_glossary(spark, sf), ML.media_glossary_rows(spark))


def _history_wide(spark, sf):
    rows = TD.media_rows(spark, sf)
    r = F.lower(F.trim("Calificacion"))
    counts = (rows.groupBy(F.trunc(F.to_date("Fecha"), "month").alias("month"))
              .agg(F.count(F.lit(1)).alias("total"),
                   F.count_if(r == M.POSITIVE).alias("positive"),
                   F.count_if(r == M.NEGATIVE).alias("negative"),
                   F.count_if(r == M.NEUTRAL).alias("neutral"),
                   F.count_if(F.col("Calificacion").isNull()).alias("unrated")))
    return ML.history_frame(counts)


def _history_unpivot(spark, sf):
    return R.history_to_long(_history_wide(spark, sf))


def _history_dirty(spark, sf):
    """C5 + J12: an earlier month, columns that are no months, missing and fractional cells."""
    wide = _history_wide(spark, sf)
    row = F.col("_row")
    return R.history_to_long(wide.select(
        "_row", F.lit("9").alias("dic-23"), F.concat(F.lit("r-"), row).alias("Concepto"),
        F.when(row == 1, F.concat(F.col("`ene-24`"), F.lit(".9"))).otherwise(F.col("`ene-24`")).alias("ene-24"),
        F.lit("x").alias("Nota"),
        F.when(row == 2, "N/A").when(row == 3, "nan").otherwise(F.col("`feb-24`")).alias("feb-24")))


def _media_history(spark, sf):
    """Q7: the wide history upserted into what the mention files left."""
    target = materialize(ML.mention_updates(TD.media_rows(spark, sf), ML.media_glossary_rows(spark)).drop("_order"))
    return U.upsert(target, materialize(_history_unpivot(spark, sf)))


def _mention_files(spark, sf):
    """A3 + G4 + C9: header discovery over raw rows; files without the columns have no counts."""
    rows, invalid = FS.mentions_from_positions(TD.positional_rows(spark, sf))
    good = M.mention_counts(rows).withColumn("valid", F.lit(True))
    bad = invalid.select("file", *[F.lit(None).cast("long").alias(c) for c in ("total", "positive", "negative", "neutral")],
                         F.lit(False).alias("valid"))
    return good.unionByName(bad)


def _report_sheet(spark, sf):
    """B5 + G2: the sheet's rows as text and numbers, with their place in the report order."""
    full = C.compare_table(TD.segments_long(spark, sf))
    return L.number_rows(RP.to_sheet(full), ["Metric", "Date"], col="row_no")


def _report_targets(spark, sf):
    """K6: analytics and current month of a run on each order's day, a fifth with a chosen month."""
    o = TD.table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("as_of"))
    target = F.when(F.col("o_orderkey") % 5 == 0, F.date_format(F.add_months("as_of", -3), "yyyy-MM"))
    analytics, current = report_month_columns(F.col("as_of"), target)
    return o.select("o_orderkey", analytics.alias("analytics_month"), current.alias("current_month"))


def _host_traffic(spark, sf):
    """Traffic of one whole host."""
    events = TD.traffic_events(spark, sf)
    host = events.agg(F.min("host")).first()[0]
    return T.traffic_report(events.where(T.host_equals("host", host)), ["host"], period="day")


def _skipped_ids(spark, sf):
    """C11: a glossary whose first name has the id 0."""
    g = TD.segments_glossary(spark, sf).select((F.col("metrica") - 1).alias("metrica"), "nombre")
    return TD.to_fact(TD.segments_long(spark, sf), g)


def _backfill_load(spark, sf):
    """Q5: the table after an earlier run is backfilled."""
    g = _traffic_glossary(spark, sf)
    earlier = _traffic_rows(spark, sf, Q.backfill_months(BACKFILL_START, PREVIOUS_RUN), as_of=PREVIOUS_RUN)
    target = materialize(L.names_to_ids(earlier, g).select("fecha", "metrica", (F.col("valor") + 1).alias("valor")))
    ev, src, props = _traffic_inputs(spark, sf)
    return Q.backfill(target, g, ev, src, props, BACKFILL_START, EVENTS_AS_OF, ads_source=TD.ADS_SOURCE)


def _store_reload(spark, sf):
    """B1+B2 on disk: the table's newest version after a reload of several months."""
    fact, glossary = TD.segments_fact(spark, sf)
    store = FactStore(spark, scratch_path(spark, "fact"))
    store.write_all(fact)
    store.replace_months(TD.segment_updates(fact, glossary))
    return store.read()


def _append_conflicts(spark, sf):
    """B2 + T14: the keys that keep the update batch, sent twice for one month, from being appended."""
    fact, glossary = TD.segments_fact(spark, sf)
    batch = TD.segment_updates(fact, glossary)
    return U.append_conflicts(fact, batch.unionByName(batch.where(F.col("fecha") == F.lit(TD.NEW_MONTH))))


def _compare_upkeep(spark, sf):
    """Q1 kept current: built from the first version of the table, then brought up to the reloaded one."""
    fact, glossary = TD.segments_fact(spark, sf)
    store = FactStore(spark, scratch_path(spark, "fact"))
    kept = UK.ComparisonStore(spark, scratch_path(spark, "compare"))
    store.write_all(fact)
    kept.refresh(store, glossary)
    store.replace_months(TD.segment_updates(fact, glossary))
    kept.refresh(store, glossary)
    return kept.read()


def _traffic_report_states(spark, sf):
    """E1 from user-day states, loaded by a run a week."""
    events = TD.traffic_events(spark, sf)
    first, last = events.agg(F.min(F.to_date("ts")), F.max(F.to_date("ts"))).first()
    states = US.TrafficStates(spark, scratch_path(spark, "states"), {"property": "string"})
    for as_of in [*(first + dt.timedelta(days=d) for d in range(7, (last - first).days, 7)), last]:
        states.advance(events, as_of, first)
    return states.report("month")


def _history_files(spark, sf):
    """A4 + I2 from CSV files, each with months of its own."""
    pattern = TD.written_files(TD.history_rows(spark, sf), scratch_path(spark, "history"))
    rows, _ = FS.read_history_files(spark, pattern)
    return rows.select(TD.file_of("file").alias("file"), "fecha", "metrica", "valor")


def _media_history_files(spark, sf):
    """Q7 whole: seeds the glossary, reads the wide history as a file, upserts into what the mention files left."""
    wide = _history_wide(spark, sf)
    names = [c for c in wide.columns if c != "_row"]
    rows = wide.select("_row", F.array(F.lit("fila"), *[F.col(f"`{c}`") for c in names]).alias("cells"))
    head = spark.range(1).select(F.lit(-1).alias("_row"), F.array(*[F.lit(c) for c in ["Concepto", *names]]).alias("cells"))
    raw = head.unionByName(rows).select(F.lit("history").alias("file"), F.col("_row").alias("pos"), "cells")
    pattern = TD.written_files(raw, scratch_path(spark, "history"))
    glossary = ML.media_glossary_rows(spark).where("metrica > 14")
    target = materialize(ML.mention_updates(TD.media_rows(spark, sf), ML.media_glossary_rows(spark)).drop("_order"))
    table, seeded = ML.media_history_load(spark, pattern, target, glossary)
    return table.join(seeded, "metrica").select("fecha", "metrica", "nombre", "valor")


def _media_load_files(spark, sf):
    """Q6 whole: header discovery over mention files of different months, counts, report month, ordered upsert."""
    pattern = TD.written_files(TD.positional_rows(spark, sf, months_apart=3), scratch_path(spark, "mentions"))
    target = materialize(_history_unpivot(spark, sf))
    return ML.media_monthly_load(spark, pattern, target, ML.media_glossary_rows(spark), strict=False)


def _snapshot_upload(spark, sf):
    """B6 + A7: two finalized snapshots and a staging one are written; the later finalized one wins."""
    fact, glossary = TD.segments_fact(spark, sf)
    long = L.ids_to_names(fact, glossary)
    root = scratch_path(spark, "snapshots")
    RP.write_snapshot(long.where(F.col("Date") < F.lit(CURRENT_MONTH)), root, "historical", "2001-08-01")
    RP.write_snapshot(long.where(F.col("Date") >= F.lit(ANALYTICS_MONTH)).withColumn("Value", F.col("Value") + 1),
                      root, "historical", "2001-09-01")
    RP.write_snapshot(long.withColumn("Value", F.lit(-1.0)), root, "current", "2001-09-15")
    return U.upsert(fact.limit(0), materialize(RP.snapshot_updates(spark, root, glossary)), order_col="_order")


def _published_tab(spark, sf):
    """B5 + C10: the tab as readers find it after a run with an empty month, which keeps the old one."""
    path = scratch_path(spark, "tab")
    tab = _analytics_slice(spark, sf)
    RP.write_tab(tab, path)
    RP.write_tab(tab.where(F.col("Date") < F.lit(dt.date(1900, 1, 1))), path)
    text = ", ".join(f"{c} {'string' if c in ('Date', 'Metric') else 'double'}" for c in tab.columns)
    return spark.read.schema(text).option("header", True).csv(published(spark, path))


def _order_before(spark, sf):
    """D6 at any size: the customer's last order as of thirty days before each order, an as-of join."""
    o = TD.table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"))
    asking = o.select("o_orderkey", "o_custkey", F.date_sub("day", 30).alias("asked"))
    source = o.select("o_custkey", F.col("day").alias("since"), F.col("o_orderkey").alias("last_orderkey"))
    return AO.as_of(asking, source, ["o_custkey"], "asked", "since", ["last_orderkey"])


def _source_overlaps(spark, sf):
    """customers' orders as sources valid for a week, an overlap wherever the next comes earlier."""
    o = TD.table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"))
    table = o.select("o_custkey", "o_orderkey", "day", F.date_add("day", 7).alias("until"),
                     F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderkey") % 3).alias("scope"))
    return AO.overlaps(table, ["o_custkey"], "day", "until", "o_orderkey", "scope").select(F.col("name").alias("o_orderkey")).distinct()


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return EXTRA_QUERIES | {
        "fiscal_year": _fiscal_year,
        "month_calendar": _month_calendar,
        "ytd": lambda s, sf: C.ytd_table(TD.segments_long(s, sf)),
        "yoy": lambda s, sf: C.compare_join(TD.segments_long(s, sf))
        .select("Date", "Metric", "year_over_year", "ytd_over_year"),
        "prev_fy": lambda s, sf: C.compare_join(TD.segments_long(s, sf))
        .select("Date", "Metric", "Previous_FY_Value"),
        "compare_full": lambda s, sf: C.compare_table(TD.customers_long(s, sf)),
        "compare_segments": lambda s, sf: C.compare_table(TD.segments_long(s, sf), path="window"),
        "compare_duplicates": _compare_duplicates,
        "yoy_duplicates": lambda s, sf: C.compare_join(TD.daily_customers_long(s, sf))
        .select("Date", "Metric", "year_over_year", "ytd_over_year"),
        "prev_fy_duplicates": lambda s, sf: C.compare_join(TD.daily_customers_long(s, sf))
        .select("Date", "Metric", "Previous_FY_Value"),
        "analytics_slice": _analytics_slice,
        "current_slice": _current_slice,
        "fact_glossary_join": _seg_report_input,
        "missing_metrics": _missing_metrics,
        "replace_months": _replace_months,
        "upsert": _upsert,
        "insert_ignore": _insert_ignore,
        "traffic_report": lambda s, sf: T.traffic_report(TD.traffic_events(s, sf), ["property"]),
        "traffic_sources": lambda s, sf: T.source_views(TD.traffic_sources(s, sf), period="month"),
        "traffic_sources_daily": lambda s, sf: T.source_views(TD.traffic_sources(s, sf), period="day"),
        "source_cutover": _source_cutover,
        "media_counts": lambda s, sf: M.mention_counts(TD.media_rows(s, sf)),
        "media_month": lambda s, sf: M.report_month(TD.media_rows(s, sf)),
        "media_metrics": lambda s, sf: M.mention_metrics(TD.media_rows(s, sf)),
        "unpivot_metrics": lambda s, sf: _traffic_rows(s, sf, Q.reload_months(EVENTS_AS_OF)),
        "history_unpivot": _history_unpivot,
        "backfill": _backfill,
        "monthly_load": _monthly_load,
        "media_load": _media_load,
        "traffic_sources_range": _traffic_sources_range,
        "video_totals": _video_totals,
        "media_dirty": lambda s, sf: M.mention_metrics(TD.dirty_media_rows(s, sf)),
        "mention_files": _mention_files,
        "history_dirty": _history_dirty,
        "media_history": _media_history,
        "report_sheet": _report_sheet,
        "report_targets": _report_targets,
        "host_traffic": _host_traffic,
        "skipped_ids": _skipped_ids,
        "backfill_load": _backfill_load,
        "store_reload": _store_reload,
        "append_conflicts": _append_conflicts,
        "compare_upkeep": _compare_upkeep,
        "traffic_report_states": _traffic_report_states,
        "history_files": _history_files,
        "media_history_files": _media_history_files,
        "media_load_files": _media_load_files,
        "snapshot_upload": _snapshot_upload,
        "published_tab": _published_tab,
        "order_before": _order_before,
        "source_overlaps": _source_overlaps,
    }


# --------------------------------------------------------------------------
# DuckDB oracles

_R2 = "round_even(({x}) * 100, 0) / 100"


def _r2(x: str) -> str:
    return _R2.format(x=x)


def _dbl(dec: str) -> str:
    """Decimal -> double, correctly rounded (through text)."""
    return f"CAST(CAST({dec} AS VARCHAR) AS DOUBLE)"


_SEG = f"""
seg AS (
  SELECT last_day(CAST(o.o_orderdate AS DATE)) AS d, c.c_mktsegment AS seg,
         count(*) AS n_orders,
         sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS revenue,
         sum(coalesce(l.n_lines, 0)) AS n_lines
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN (SELECT l_orderkey, count(*) AS n_lines FROM lineitem GROUP BY l_orderkey) l
    ON l.l_orderkey = o.o_orderkey
  GROUP BY 1, 2),
seg_long AS (
  SELECT d AS Date, seg || ' Total Orders' AS Metric, CAST(n_orders AS DOUBLE) AS Value FROM seg
  UNION ALL SELECT d, seg || ' Revenue', {_dbl('revenue')} FROM seg
  UNION ALL SELECT d, seg || ' Lines Per Session', {_r2('CAST(n_lines AS DOUBLE) / n_orders')} FROM seg),
seg_glossary AS (
  SELECT CAST(row_number() OVER (ORDER BY nombre) AS INTEGER) AS metrica, nombre
  FROM (SELECT DISTINCT Metric AS nombre FROM seg_long)),
seg_fact AS (
  SELECT l.Date AS fecha, g.metrica, l.Value AS valor
  FROM seg_long l JOIN seg_glossary g ON l.Metric = g.nombre),
seg_input AS (
  SELECT f.fecha AS Date, g.nombre AS Metric, f.valor AS Value
  FROM seg_fact f JOIN seg_glossary g ON f.metrica = g.metrica),
seg_updates AS (
  SELECT f.fecha, f.metrica, f.valor + 1 AS valor
  FROM seg_fact f JOIN seg_glossary g ON f.metrica = g.metrica
  WHERE CAST(date_trunc('month', f.fecha) AS DATE) IN (DATE '2001-06-01', DATE '2001-07-01')
    AND NOT suffix(g.nombre, 'Lines Per Session')
  UNION ALL
  SELECT DATE '2001-09-30', metrica, valor FROM seg_fact
  WHERE CAST(date_trunc('month', fecha) AS DATE) = DATE '2001-07-01')"""

_SEG_RELOADED = """
reloaded AS (
  SELECT fecha, metrica, valor FROM seg_fact f
  WHERE NOT (EXISTS (SELECT 1 FROM seg_updates u
                     WHERE year(u.fecha) = year(f.fecha) AND month(u.fecha) = month(f.fecha))
             AND f.metrica IN (SELECT metrica FROM seg_updates))
  UNION ALL SELECT fecha, metrica, valor FROM seg_updates)"""

_CUST = """
cust_long AS (
  SELECT last_day(CAST(o.o_orderdate AS DATE)) AS Date, c.c_name AS Metric,
         CAST(count(*) AS DOUBLE) AS Value
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1, 2)"""


# several rows per metric-month, null values, null names, copies of rows
_DAILY = """
day_long AS (
  SELECT CAST(o.o_orderdate AS DATE) AS Date,
         CASE WHEN o.o_orderkey % 101 <> 0 THEN c.c_name
              || CASE WHEN o.o_custkey % 3 = 0 THEN ' Lines Per Session' ELSE ' Orders' END END AS Metric,
         CASE WHEN o.o_orderkey % 7 <> 0 THEN CAST(o.o_orderkey % 5 AS DOUBLE) / 4 END AS Value
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)"""


def _compare(src: str) -> str:
    """CTEs cmp_base .. cmp_out over ``src`` (Date, Metric, Value): reference semantics."""
    s = _dbl("s")
    return f"""
cmp_base AS (
  SELECT Date, Metric, Value,
         CAST(CASE WHEN month(Date) >= 8 THEN year(Date) ELSE year(Date) - 1 END AS INTEGER) AS fy,
         CAST(year(Date) AS INTEGER) AS yr, CAST(month(Date) AS INTEGER) AS mo,
         contains(Metric, 'Session') AS is_mean
  FROM {src} WHERE Date IS NOT NULL AND Metric IS NOT NULL),
cmp_run AS (
  SELECT *, sum(CAST(Value AS DECIMAL(38,6))) OVER w AS s, count(*) OVER w AS n
  FROM cmp_base
  WINDOW w AS (PARTITION BY Metric, fy ORDER BY Date, Value NULLS LAST
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
cmp_ytd AS (
  SELECT Date, Metric, Value, fy, yr, mo, is_mean,
         CASE WHEN Value IS NULL THEN NULL
              ELSE {_r2(f"CASE WHEN is_mean THEN {s} / n ELSE {s} END")} END AS ytd
  FROM cmp_run),
cmp_join AS (
  SELECT a.*, b.Value AS year_over_year, {_r2('b.ytd')} AS ytd_over_year
  FROM cmp_ytd a LEFT JOIN cmp_ytd b
    ON a.Metric = b.Metric AND a.mo = b.mo AND a.yr - 1 = b.yr),
cmp_fy AS (
  SELECT Metric, fy + 1 AS fy, sum(CAST(Value AS DECIMAL(38,6))) AS s, count(Value) AS n,
         contains(Metric, 'Session') AS is_mean
  FROM cmp_join GROUP BY Metric, fy),
cmp_out AS (
  SELECT j.Date, j.Metric, coalesce(j.Value, 0) AS Value, coalesce(j.ytd, 0) AS ytd,
         coalesce(j.year_over_year, 0) AS year_over_year,
         coalesce(j.ytd_over_year, 0) AS ytd_over_year,
         coalesce({_r2(f"CASE WHEN f.is_mean THEN {_dbl('f.s')} / nullif(f.n, 0) ELSE {_dbl('f.s')} END")}, 0)
           AS Previous_FY_Value
  FROM cmp_join j LEFT JOIN cmp_fy f ON j.Metric = f.Metric AND j.fy = f.fy)"""


_TEV = """
page_hosts AS (
  SELECT page_id, host, regexp_extract(host, '([^.]*)$', 1) AS property,
         split_part(host, '.', 1) AS site, split_part(url, '://', 1) AS scheme
  FROM (SELECT page_id, url,
               regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)', 1) AS host
        FROM pages)),
tev AS (
  SELECT e.ts, e.user_id, e.event_type = 'view' AS is_view, p.host, p.property, p.site, p.scheme
  FROM events e JOIN page_hosts p ON e.event_id % (SELECT count(*) FROM pages) = p.page_id),
props AS (SELECT DISTINCT property FROM page_hosts WHERE property IS NOT NULL)"""


def _sessions(src: str, key: str, period: str, name: str) -> str:
    """Per-(key, period) users/views/sessions over events ``src`` (lag form), each period alone."""
    trunc = "CAST(ts AS DATE)" if period == "day" else "CAST(date_trunc('month', ts) AS DATE)"
    return f"""
{name}_s AS (
  SELECT {key}, user_id, ts, is_view,
         CASE WHEN lag(ts) OVER w IS NULL
                OR epoch_us(ts) - epoch_us(lag(ts) OVER w) >= 1800000000 THEN 1 ELSE 0 END AS is_start
  FROM {src} WINDOW w AS (PARTITION BY {key}, user_id, {trunc} ORDER BY ts)),
{name} AS (
  SELECT {key}, {trunc} AS period_start,
         CAST(count(DISTINCT user_id) AS BIGINT) AS users,
         CAST(sum(CAST(is_view AS BIGINT)) AS BIGINT) AS views,
         CAST(sum(is_start) AS BIGINT) AS sessions,
         coalesce({_r2('CAST(sum(CAST(is_view AS BIGINT)) AS DOUBLE) / nullif(sum(is_start), 0)')}, 0)
           AS views_per_session
  FROM {name}_s GROUP BY 1, 2)"""


def _traffic_rows_sql(months: list[dt.date], name: str, as_of: dt.date = EVENTS_AS_OF) -> str:
    lo = months[0].isoformat()
    hi = (as_of + dt.timedelta(days=1)).isoformat()
    mvals = ", ".join(f"(DATE '{m.isoformat()}')" for m in months)
    asof = as_of.isoformat()
    fe = f"least(last_day(m.m), DATE '{asof}')"
    return f"""
{name}_ev AS (SELECT * FROM tev WHERE ts >= TIMESTAMP '{lo}' AND ts < TIMESTAMP '{hi}'),
{_sessions(f'{name}_ev', 'property', 'month', f'{name}_rep').strip()},
{name}_m AS (SELECT * FROM (VALUES {mvals}) v(m)),
{name}_vt AS (
  SELECT CAST(date_trunc('month', ts) AS DATE) AS m, count(*) AS total,
         count(*) FILTER (WHERE event_type = '{TD.ADS_SOURCE}') AS ads
  FROM events WHERE ts >= TIMESTAMP '{lo}' AND ts < TIMESTAMP '{hi}' GROUP BY 1),
{name} AS (
  SELECT {fe} AS fecha, p.property || ' Total Users' AS Metric,
         CAST(coalesce(r.users, 0) AS DOUBLE) AS valor
  FROM props p CROSS JOIN {name}_m m
  LEFT JOIN {name}_rep r ON r.property = p.property AND r.period_start = m.m
  UNION ALL
  SELECT {fe}, p.property || ' Views', CAST(coalesce(r.views, 0) AS DOUBLE)
  FROM props p CROSS JOIN {name}_m m
  LEFT JOIN {name}_rep r ON r.property = p.property AND r.period_start = m.m
  UNION ALL
  SELECT {fe}, p.property || ' Views Per Session', CAST(coalesce(r.views_per_session, 0) AS DOUBLE)
  FROM props p CROSS JOIN {name}_m m
  LEFT JOIN {name}_rep r ON r.property = p.property AND r.period_start = m.m
  UNION ALL
  SELECT {fe}, 'Video Advertisement Views', CAST(coalesce(v.ads, 0) AS DOUBLE)
  FROM {name}_m m LEFT JOIN {name}_vt v ON v.m = m.m
  UNION ALL
  SELECT {fe}, 'Video Organic Views', CAST(coalesce(v.total - v.ads, 0) AS DOUBLE)
  FROM {name}_m m LEFT JOIN {name}_vt v ON v.m = m.m
  UNION ALL
  SELECT {fe}, 'Video Total Views', CAST(coalesce(v.total, 0) AS DOUBLE)
  FROM {name}_m m LEFT JOIN {name}_vt v ON v.m = m.m)"""


_TRAFFIC_GLOSSARY = f"""
tnames AS (
  SELECT p.property || ' ' || l.label AS Metric
  FROM props p CROSS JOIN (VALUES ('Total Users'), ('Views'), ('Views Per Session')) l(label)
  UNION
  SELECT * FROM (VALUES ('Video Advertisement Views'), ('Video Organic Views'),
                        ('Video Total Views')) v(Metric)),
tg AS (
  SELECT CAST(row_number() OVER (ORDER BY nombre) AS INTEGER) AS metrica, nombre
  FROM (SELECT DISTINCT Metric AS nombre FROM tnames
        WHERE NOT starts_with(Metric, '{UNREGISTERED_PROPERTY} ')))"""

_MEDIA = """
mrows AS (
  SELECT d.source AS file,
         strftime(DATE '2024-01-01' + CAST(d.doc_id % 60 AS INTEGER), '%Y-%m-%d') AS Fecha,
         CASE WHEN l.toxic = 1 THEN 'negativa' WHEN l.quality = 1 THEN 'positiva'
              WHEN l.quality = 0 THEN 'neutra' END AS Calificacion
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
mcounts AS (
  SELECT file, count(*) AS total,
         count(*) FILTER (WHERE lower(trim(Calificacion)) = 'positiva') AS positive,
         count(*) FILTER (WHERE lower(trim(Calificacion)) = 'negativa') AS negative,
         count(*) FILTER (WHERE lower(trim(Calificacion)) = 'neutra') AS neutral
  FROM mrows GROUP BY file),
mdates AS (SELECT file, try_strptime(Fecha, '%Y-%m-%d') AS d FROM mrows),
my AS (
  SELECT file, y FROM (
    SELECT file, y, row_number() OVER (PARTITION BY file ORDER BY c DESC, y) AS rn
    FROM (SELECT file, year(d) AS y, count(*) AS c FROM mdates WHERE d IS NOT NULL GROUP BY 1, 2))
  WHERE rn = 1),
mm AS (
  SELECT file, m FROM (
    SELECT file, m, row_number() OVER (PARTITION BY file ORDER BY c DESC, m) AS rn
    FROM (SELECT file, month(d) AS m, count(*) AS c FROM mdates WHERE d IS NOT NULL GROUP BY 1, 2))
  WHERE rn = 1),
mmonth AS (
  SELECT my.file, last_day(make_date(CAST(my.y AS INTEGER), CAST(mm.m AS INTEGER), 1)) AS fecha
  FROM my JOIN mm ON my.file = mm.file)"""


# of several files of one month the last by name wins, with all its counts
_LAST_FILE = """
upd AS (
  SELECT m.fecha, x.metrica, x.valor
  FROM (SELECT fecha, max(file) AS file FROM mmonth GROUP BY 1) m JOIN mcounts c ON c.file = m.file,
  LATERAL (VALUES (13, CAST(c.total AS DOUBLE)), (14, CAST(c.positive AS DOUBLE)),
                  (15, CAST(c.negative AS DOUBLE)), (16, CAST(c.neutral AS DOUBLE))) x(metrica, valor))"""

_HISTORY = """
hm AS (
  SELECT CAST(date_trunc('month', CAST(Fecha AS DATE)) AS DATE) AS m, count(*) AS total,
         count(*) FILTER (WHERE lower(trim(Calificacion)) = 'positiva') AS positive,
         count(*) FILTER (WHERE lower(trim(Calificacion)) = 'negativa') AS negative,
         count(*) FILTER (WHERE lower(trim(Calificacion)) = 'neutra') AS neutral
  FROM mrows GROUP BY 1),
hist AS (
  SELECT last_day(m) AS fecha, x.metrica, x.valor FROM hm,
  LATERAL (VALUES (13, CAST(total AS DOUBLE)), (14, CAST(positive AS DOUBLE)),
                  (15, CAST(negative AS DOUBLE)), (16, CAST(neutral AS DOUBLE))) x(metrica, valor)
  WHERE m >= DATE '2024-01-01')"""

_DIRTY = """
drows AS (
  SELECT file,
         CASE dayofyear(CAST(Fecha AS DATE)) % 13 WHEN 0 THEN '2024-02-30' WHEN 1 THEN ' ' || Fecha WHEN 2 THEN '2024-1-5'
              WHEN 3 THEN Fecha || ' 10:00' WHEN 4 THEN NULL ELSE Fecha END AS Fecha,
         p.pad || CASE dayofyear(CAST(Fecha AS DATE)) % 3 WHEN 0 THEN upper(Calificacion)
                       WHEN 1 THEN upper(Calificacion[1]) || lower(Calificacion[2:]) ELSE Calificacion END || p.pad AS Calificacion
  FROM mrows JOIN (VALUES (0, chr(160)), (1, chr(9) || ' '), (2, '  '), (3, '')) p(k, pad)
    ON dayofyear(CAST(Fecha AS DATE)) % 4 = p.k),
dlab AS (
  SELECT file, lower(trim(Calificacion, ' ' || chr(9) || chr(160))) AS label,
         CASE WHEN regexp_full_match(Fecha, '[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}') THEN try_strptime(Fecha, '%Y-%m-%d') END AS d
  FROM drows),
dcounts AS (
  SELECT file, count(*) AS total, count(*) FILTER (WHERE label = 'positiva') AS positive,
         count(*) FILTER (WHERE label = 'negativa') AS negative, count(*) FILTER (WHERE label = 'neutra') AS neutral
  FROM dlab GROUP BY 1),
dy AS (SELECT file, y FROM (SELECT file, year(d) AS y, row_number() OVER (PARTITION BY file ORDER BY count(*) DESC, year(d)) AS rn
       FROM dlab WHERE d IS NOT NULL GROUP BY 1, 2) WHERE rn = 1),
dm AS (SELECT file, m FROM (SELECT file, month(d) AS m, row_number() OVER (PARTITION BY file ORDER BY count(*) DESC, month(d)) AS rn
       FROM dlab WHERE d IS NOT NULL GROUP BY 1, 2) WHERE rn = 1)"""


def oracle_sql() -> dict[str, str]:
    asof_o = ORDERS_AS_OF.isoformat()
    reload = Q.reload_months(EVENTS_AS_OF)
    bf_months = Q.backfill_months(BACKFILL_START, EVENTS_AS_OF)
    a_lo, a_hi = ANALYTICS_MONTH.isoformat(), "2001-08-01"
    c_lo, c_hi = CURRENT_MONTH.isoformat(), "2001-09-01"
    cut = ", ".join(
        f"('{n}', '{s}', DATE '{f.isoformat()}', DATE '{t.isoformat()}', "
        f"{'NULL' if h is None else repr(h)})" for n, s, f, t, h in CUTOVER_ROWS)
    media_vals = ", ".join(f"({i}, '{n}')" for i, n in M.MEDIA_METRICS)
    return EXTRA_ORACLES | {
        "fiscal_year": """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date,
       CAST(CASE WHEN month(o_orderdate) >= 8 THEN year(o_orderdate)
                 ELSE year(o_orderdate) - 1 END AS INTEGER) AS fiscal_year
FROM orders""",
        "month_calendar": f"""
SELECT CAST(m AS DATE) AS month_start,
       least(last_day(CAST(m AS DATE)), DATE '{asof_o}') AS period_end,
       CAST(CASE WHEN month(m) >= 8 THEN year(m) ELSE year(m) - 1 END AS INTEGER) AS fiscal_year
FROM (SELECT unnest(generate_series(date_trunc('month', min(o_orderdate)),
                                    TIMESTAMP '{asof_o}', INTERVAL 1 MONTH)) AS m FROM orders)""",
        "ytd": f"WITH {_SEG},{_compare('seg_long')}\n"
               "SELECT Date, Metric, Value, fy AS fiscal_year, ytd FROM cmp_ytd",
        "yoy": f"WITH {_SEG},{_compare('seg_long')}\n"
               "SELECT Date, Metric, year_over_year, ytd_over_year FROM cmp_out",
        "prev_fy": f"WITH {_SEG},{_compare('seg_long')}\n"
                   "SELECT Date, Metric, Previous_FY_Value FROM cmp_out",
        "compare_full": f"WITH {_CUST},{_compare('cust_long')}\nSELECT * FROM cmp_out",
        "compare_segments": f"WITH {_SEG},{_compare('seg_long')}\nSELECT * FROM cmp_out",
        "compare_duplicates": f"WITH {_DAILY},{_compare('day_long')}\nSELECT * FROM cmp_out",
        "yoy_duplicates": f"""WITH {_DAILY},{_compare('day_long')}
SELECT Date, Metric, year_over_year, ytd_over_year FROM cmp_out""",
        "prev_fy_duplicates": f"""WITH {_DAILY},{_compare('day_long')}
SELECT Date, Metric, Previous_FY_Value FROM cmp_out""",
        "analytics_slice": f"WITH {_SEG},{_compare('seg_input')}\n"
                           f"SELECT * FROM cmp_out WHERE Date >= DATE '{a_lo}' AND Date < DATE '{a_hi}'",
        "current_slice": f"WITH {_SEG},{_compare('seg_input')}\n"
                         "SELECT Date, Metric, Value, Previous_FY_Value FROM cmp_out "
                         f"WHERE Date >= DATE '{c_lo}' AND Date < DATE '{c_hi}'",
        "fact_glossary_join": f"WITH {_SEG}\nSELECT * FROM seg_input",
        "missing_metrics": f"WITH {_TEV},{_traffic_rows_sql(bf_months, 'bf')},"
                           f"{_traffic_rows_sql(reload, 'rl')},{_TRAFFIC_GLOSSARY}\n"
                           "SELECT DISTINCT Metric FROM rl WHERE Metric NOT IN (SELECT nombre FROM tg)",
        "replace_months": f"WITH {_SEG},{_SEG_RELOADED}\nSELECT * FROM reloaded",
        "store_reload": f"WITH {_SEG},{_SEG_RELOADED}\nSELECT * FROM reloaded",
        "compare_upkeep": f"""WITH {_SEG},{_SEG_RELOADED},
reloaded_long AS (
  SELECT r.fecha AS Date, g.nombre AS Metric, r.valor AS Value
  FROM reloaded r JOIN seg_glossary g ON g.metrica = r.metrica),{_compare('reloaded_long')}
SELECT * FROM cmp_out""",
        "append_conflicts": f"""WITH {_SEG},
batch AS (SELECT * FROM seg_updates UNION ALL SELECT * FROM seg_updates WHERE fecha = DATE '{TD.NEW_MONTH.isoformat()}')
SELECT b.fecha, b.metrica, count(*) AS copies,
       any_value(EXISTS (SELECT 1 FROM seg_fact f WHERE f.fecha = b.fecha AND f.metrica = b.metrica)) AS "exists"
FROM batch b GROUP BY 1, 2 HAVING "exists" OR copies > 1""",
        "upsert": f"""WITH {_SEG}
SELECT fecha, metrica, valor FROM seg_fact f
WHERE NOT EXISTS (SELECT 1 FROM seg_updates u WHERE u.fecha = f.fecha AND u.metrica = f.metrica)
UNION ALL SELECT fecha, metrica, max(valor) AS valor FROM seg_updates GROUP BY fecha, metrica""",
        "insert_ignore": f"""WITH {_SEG}
SELECT metrica, nombre FROM seg_glossary
UNION ALL
SELECT metrica, nombre FROM (VALUES {media_vals}) v(metrica, nombre)
WHERE metrica NOT IN (SELECT metrica FROM seg_glossary)""",
        "traffic_report": f"WITH {_TEV},{_sessions('tev', 'property', 'month', 'rep')}\nSELECT * FROM rep",
        "traffic_report_states": f"WITH {_TEV},{_sessions('tev', 'property', 'month', 'rep')}\nSELECT * FROM rep",
        "traffic_sources": """
SELECT event_type AS source, CAST(date_trunc('month', ts) AS DATE) AS month,
       CAST(count(*) AS BIGINT) AS views
FROM events GROUP BY 1, 2""",
        "traffic_sources_daily": """
SELECT event_type AS source, CAST(ts AS DATE) AS day, CAST(count(*) AS BIGINT) AS views
FROM events GROUP BY 1, 2""",
        "traffic_sources_range": f"""
SELECT event_type AS source, CAST(count(*) AS BIGINT) AS views FROM events
WHERE ts >= TIMESTAMP '{EVENTS_RANGE[0].isoformat()}'
  AND ts < TIMESTAMP '{(EVENTS_RANGE[1] + dt.timedelta(days=1)).isoformat()}'
GROUP BY 1""",
        "video_totals": f"""
SELECT CAST(date_trunc('month', ts) AS DATE) AS month, CAST(count(*) AS BIGINT) AS total_views,
       CAST(count(*) FILTER (WHERE event_type = '{TD.ADS_SOURCE}') AS BIGINT) AS ads_views,
       CAST(count(*) - count(*) FILTER (WHERE event_type = '{TD.ADS_SOURCE}') AS BIGINT) AS organic_views
FROM events GROUP BY 1""",
        "source_cutover": f"""WITH {_TEV},
cut AS (SELECT * FROM (VALUES {cut}) v(source_name, scheme, valid_from, valid_to, site_filter)),
cev AS (
  SELECT c.source_name, t.* FROM tev t JOIN cut c
    ON t.scheme = c.scheme AND CAST(t.ts AS DATE) >= c.valid_from AND CAST(t.ts AS DATE) < c.valid_to
   AND (c.site_filter IS NULL OR t.site = c.site_filter)),
{_sessions('cev', 'source_name', 'day', 'crep').strip()}
SELECT * FROM crep""",
        "media_counts": f"WITH {_MEDIA}\nSELECT * FROM mcounts",
        "media_month": f"WITH {_MEDIA}\nSELECT * FROM mmonth",
        "media_metrics": f"""WITH {_MEDIA}
SELECT c.file, m.fecha, x.Metric, x.valor
FROM mcounts c JOIN mmonth m ON c.file = m.file,
LATERAL (VALUES ('Total Media Mentions', CAST(c.total AS DOUBLE)),
                ('Positive Media Mentions', CAST(c.positive AS DOUBLE)),
                ('Negative Media Mentions', CAST(c.negative AS DOUBLE)),
                ('Neutral Media Mentions', CAST(c.neutral AS DOUBLE))) x(Metric, valor)""",
        "unpivot_metrics": f"WITH {_TEV},{_traffic_rows_sql(reload, 'rl')}\nSELECT * FROM rl",
        "history_unpivot": f"""WITH {_MEDIA},
hm AS (
  SELECT CAST(date_trunc('month', CAST(Fecha AS DATE)) AS DATE) AS m, count(*) AS total,
         count(*) FILTER (WHERE lower(trim(Calificacion)) = 'positiva') AS positive,
         count(*) FILTER (WHERE lower(trim(Calificacion)) = 'negativa') AS negative,
         count(*) FILTER (WHERE lower(trim(Calificacion)) = 'neutra') AS neutral
  FROM mrows GROUP BY 1)
SELECT last_day(m) AS fecha, x.metrica, x.valor FROM hm,
LATERAL (VALUES (13, CAST(total AS DOUBLE)), (14, CAST(positive AS DOUBLE)),
                (15, CAST(negative AS DOUBLE)), (16, CAST(neutral AS DOUBLE))) x(metrica, valor)
WHERE m >= DATE '2024-01-01'""",
        "backfill": f"""WITH {_TEV},{_traffic_rows_sql(bf_months, 'bf')},{_TRAFFIC_GLOSSARY}
SELECT b.fecha, g.metrica, b.valor FROM bf b JOIN tg g ON b.Metric = g.nombre""",
        "monthly_load": f"""WITH {_TEV},
{_traffic_rows_sql(Q.backfill_months(BACKFILL_START, PREVIOUS_RUN), 'old', PREVIOUS_RUN).strip()},
{_traffic_rows_sql(reload, 'rl').strip()},{_TRAFFIC_GLOSSARY},
target AS (SELECT o.fecha, g.metrica, o.valor FROM old o JOIN tg g ON o.Metric = g.nombre),
upd AS (SELECT r.fecha, g.metrica, r.valor FROM rl r JOIN tg g ON r.Metric = g.nombre)
SELECT fecha, metrica, valor FROM target t
WHERE NOT (EXISTS (SELECT 1 FROM upd u WHERE year(u.fecha) = year(t.fecha) AND month(u.fecha) = month(t.fecha))
           AND t.metrica IN (SELECT metrica FROM upd))
UNION ALL SELECT fecha, metrica, valor FROM upd""",
        "media_load": f"""WITH {_MEDIA},
hm AS (
  SELECT CAST(date_trunc('month', CAST(Fecha AS DATE)) AS DATE) AS m, count(*) AS total,
         count(*) FILTER (WHERE lower(trim(Calificacion)) = 'positiva') AS positive,
         count(*) FILTER (WHERE lower(trim(Calificacion)) = 'negativa') AS negative,
         count(*) FILTER (WHERE lower(trim(Calificacion)) = 'neutra') AS neutral
  FROM mrows GROUP BY 1),
target AS (
  SELECT last_day(m) AS fecha, x.metrica, x.valor FROM hm,
  LATERAL (VALUES (13, CAST(total AS DOUBLE)), (14, CAST(positive AS DOUBLE)),
                  (15, CAST(negative AS DOUBLE)), (16, CAST(neutral AS DOUBLE))) x(metrica, valor)
  WHERE m >= DATE '2024-01-01'),
{_LAST_FILE}
SELECT fecha, metrica, valor FROM target t
WHERE NOT EXISTS (SELECT 1 FROM upd u WHERE u.fecha = t.fecha AND u.metrica = t.metrica)
UNION ALL SELECT fecha, metrica, valor FROM upd""",
        "media_dirty": f"""WITH {_MEDIA},{_DIRTY}
SELECT c.file, last_day(make_date(CAST(dy.y AS INTEGER), CAST(dm.m AS INTEGER), 1)) AS fecha, x.Metric, x.valor
FROM dcounts c JOIN dy ON c.file = dy.file JOIN dm ON c.file = dm.file,
LATERAL (VALUES ('Total Media Mentions', CAST(c.total AS DOUBLE)),
                ('Positive Media Mentions', CAST(c.positive AS DOUBLE)),
                ('Negative Media Mentions', CAST(c.negative AS DOUBLE)),
                ('Neutral Media Mentions', CAST(c.neutral AS DOUBLE))) x(Metric, valor)""",
        "mention_files": f"""WITH {_MEDIA},
files AS (SELECT DISTINCT file, coalesce(TRY_CAST(regexp_extract(file, '[0-9]+') AS INTEGER), 0) AS k FROM mrows),
judged AS (SELECT file, k % 12 < 10 AND k % 7 <> 3 AS valid FROM files)
SELECT j.file, j.valid, CASE WHEN j.valid THEN c.total END AS total, CASE WHEN j.valid THEN c.positive END AS positive,
       CASE WHEN j.valid THEN c.negative END AS negative, CASE WHEN j.valid THEN c.neutral END AS neutral
FROM judged j JOIN mcounts c ON c.file = j.file""",
        "history_dirty": f"""WITH {_MEDIA},{_HISTORY}
SELECT fecha, metrica, CASE WHEN month(fecha) = 2 AND metrica IN (15, 16) THEN 0 ELSE valor END AS valor FROM hist""",
        "media_history": f"""WITH {_MEDIA},{_LAST_FILE},{_HISTORY}
SELECT fecha, metrica, valor FROM upd u
WHERE NOT EXISTS (SELECT 1 FROM hist h WHERE h.fecha = u.fecha AND h.metrica = u.metrica)
UNION ALL SELECT fecha, metrica, valor FROM hist""",
        "history_files": f"""WITH {_MEDIA},
hf AS (
  SELECT d.source AS file, coalesce(TRY_CAST(regexp_extract(d.source, '[0-9]+') AS INTEGER), 0) AS k, d.doc_id % 5 AS j,
         CASE WHEN l.toxic = 1 THEN 'negative' WHEN l.quality = 1 THEN 'positive' WHEN l.quality = 0 THEN 'neutral' END AS rating
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
hc AS (
  SELECT f.file, f.k, j.j, count(h.file) AS total, count(*) FILTER (WHERE rating = 'positive') AS positive,
         count(*) FILTER (WHERE rating = 'negative') AS negative, count(*) FILTER (WHERE rating = 'neutral') AS neutral
  FROM (SELECT DISTINCT file, k FROM hf) f CROSS JOIN range({TD.HISTORY_MONTHS}) j(j)
  LEFT JOIN hf h ON h.file = f.file AND h.j = j.j GROUP BY 1, 2, 3)
SELECT file, last_day(DATE '2024-01-01' + to_months(CAST(CASE WHEN j = 0 THEN 0 ELSE k % 4 + j END AS INTEGER))) AS fecha, x.metrica, x.valor
FROM hc, LATERAL (VALUES (13, CAST(total AS DOUBLE)), (14, CAST(positive AS DOUBLE)), (15, CAST(negative AS DOUBLE)),
                         (16, CAST(CASE WHEN k % 2 = 1 THEN 0 ELSE neutral END AS DOUBLE))) x(metrica, valor)""",
        "media_history_files": f"""WITH {_MEDIA},{_LAST_FILE},{_HISTORY},
done AS (
  SELECT fecha, metrica, valor FROM upd u
  WHERE NOT EXISTS (SELECT 1 FROM hist h WHERE h.fecha = u.fecha AND h.metrica = u.metrica)
  UNION ALL SELECT fecha, metrica, valor FROM hist)
SELECT d.fecha, d.metrica, v.nombre, d.valor FROM done d JOIN (VALUES {media_vals}) v(metrica, nombre) ON v.metrica = d.metrica""",
        "media_load_files": f"""WITH {_MEDIA},{_HISTORY},
numbered AS (SELECT *, coalesce(TRY_CAST(regexp_extract(file, '[0-9]+') AS INTEGER), 0) AS k FROM mrows),
moved AS (
  SELECT file, Calificacion, CAST(CAST(Fecha AS DATE) + to_months(3 * k) AS DATE) AS d
  FROM numbered WHERE k % 12 < 10 AND k % 7 <> 3),
ymode AS (SELECT file, y FROM (SELECT file, year(d) AS y, row_number() OVER (PARTITION BY file ORDER BY count(*) DESC, year(d)) AS rn
          FROM moved GROUP BY 1, 2) WHERE rn = 1),
mmode AS (SELECT file, m FROM (SELECT file, month(d) AS m, row_number() OVER (PARTITION BY file ORDER BY count(*) DESC, month(d)) AS rn
          FROM moved GROUP BY 1, 2) WHERE rn = 1),
files AS (SELECT last_day(make_date(CAST(y AS INTEGER), CAST(m AS INTEGER), 1)) AS fecha, c.*
          FROM ymode JOIN mmode USING (file) JOIN mcounts c USING (file)),
new AS (
  SELECT fecha, x.metrica, x.valor FROM files,
  LATERAL (VALUES (13, CAST(total AS DOUBLE)), (14, CAST(positive AS DOUBLE)),
                  (15, CAST(negative AS DOUBLE)), (16, CAST(neutral AS DOUBLE))) x(metrica, valor))
SELECT fecha, metrica, valor FROM hist h
WHERE NOT EXISTS (SELECT 1 FROM new n WHERE n.fecha = h.fecha AND n.metrica = h.metrica)
UNION ALL SELECT fecha, metrica, valor FROM new""",
        "order_before": """
WITH o AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day FROM orders),
last AS (SELECT o_custkey, day, max(o_orderkey) AS last_orderkey FROM o GROUP BY 1, 2)
SELECT a.o_orderkey, a.o_custkey, CAST(a.day - 30 AS DATE) AS asked, l.day AS since, l.last_orderkey
FROM o a ASOF LEFT JOIN last l ON l.o_custkey = a.o_custkey AND a.day - 30 >= l.day""",
        "source_overlaps": """
WITH o AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day, nullif(o_orderkey % 3, 0) AS scope FROM orders),
r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY day, o_orderkey) AS rn FROM o)
SELECT DISTINCT b.o_orderkey FROM r a JOIN r b ON a.o_custkey = b.o_custkey AND a.rn < b.rn
 AND b.day < a.day + 7 AND (a.scope IS NULL OR b.scope IS NULL OR a.scope = b.scope)""",
        "snapshot_upload": f"""WITH {_SEG}
SELECT fecha, metrica, CASE WHEN fecha >= DATE '{a_lo}' THEN valor + 1 ELSE valor END AS valor FROM seg_fact""",
        "published_tab": f"""WITH {_SEG},{_compare('seg_input')}
SELECT strftime(Date, '%Y-%m-%d') AS Date, Metric, Value, ytd, year_over_year, ytd_over_year, Previous_FY_Value
FROM cmp_out WHERE Date >= DATE '{a_lo}' AND Date < DATE '{a_hi}'""",
        "report_sheet": f"""WITH {_SEG},{_compare('seg_long')}
SELECT strftime(Date, '%Y-%m-%d') AS Date, Metric, Value, ytd, year_over_year, ytd_over_year, Previous_FY_Value,
       row_number() OVER (ORDER BY Metric, Date) AS row_no
FROM cmp_out""",
        "report_targets": """
SELECT o_orderkey,
       CAST(CASE WHEN o_orderkey % 5 = 0 THEN date_trunc('month', o_orderdate) - INTERVAL 3 MONTH
                 ELSE date_trunc('month', o_orderdate) - INTERVAL 1 MONTH END AS DATE) AS analytics_month,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS current_month
FROM orders""",
        "host_traffic": f"""WITH {_TEV},
one AS (SELECT * FROM tev WHERE host = (SELECT min(host) FROM tev)),
{_sessions('one', 'host', 'day', 'hrep').strip()}
SELECT * FROM hrep""",
        "skipped_ids": f"""WITH {_SEG}
SELECT fecha, CAST(metrica - 1 AS INTEGER) AS metrica, valor FROM seg_fact WHERE metrica <> 1""",
        "backfill_load": f"""WITH {_TEV},
{_traffic_rows_sql(Q.backfill_months(BACKFILL_START, PREVIOUS_RUN), 'old', PREVIOUS_RUN).strip()},
{_traffic_rows_sql(bf_months, 'bf').strip()},{_TRAFFIC_GLOSSARY},
target AS (SELECT o.fecha, g.metrica, o.valor + 1 AS valor FROM old o JOIN tg g ON o.Metric = g.nombre),
upd AS (SELECT b.fecha, g.metrica, b.valor FROM bf b JOIN tg g ON b.Metric = g.nombre)
SELECT fecha, metrica, valor FROM target t
WHERE NOT (EXISTS (SELECT 1 FROM upd u WHERE year(u.fecha) = year(t.fecha) AND month(u.fecha) = month(t.fecha))
           AND t.metrica IN (SELECT metrica FROM upd))
UNION ALL SELECT fecha, metrica, valor FROM upd""",
    }
