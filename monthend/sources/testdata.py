"""Inputs derived from the driver's tables (``<sf_dir>/<name>.parquet``).

The reference reads a MySQL fact table, web-analytics APIs and monthly CSV
files; none exist here, so each is re-aimed on the given tables (see
FIXTURES.md section 3). Every derivation is a Spark job over the whole
tables; only the columns used are read (Parquet column pruning).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monthend.functions.numeric import round2
from monthend.functions.text import spanish_month_label
from monthend.operators.lookup import build_glossary, names_to_ids
from monthend.session import materialize

# Fixed values of the test derivations (FIXTURES.md section 3).
SEGMENT_KINDS = ("Total Orders", "Revenue", "Lines Per Session")
UPDATE_MONTHS = (dt.date(2001, 6, 1), dt.date(2001, 7, 1))   # reloaded months
NEW_MONTH_FROM = dt.date(2001, 7, 1)                          # copied to ...
NEW_MONTH = dt.date(2001, 9, 30)                              # ... this new month
MEDIA_FIRST_DAY = dt.date(2024, 1, 1)                         # mention dates start here
MEDIA_DAYS = 60                                               # and cycle over 60 days
ADS_SOURCE = "click"                                          # plays the ADVERTISING role


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _orders_by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return (o.join(c, o.o_custkey == c.c_custkey)
            .withColumn("Date", F.last_day(F.to_date("o_orderdate"))))


def segments_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fact_segments as (Date, Metric, Value): 3 metrics per (month, segment).

    ``<seg> Total Orders`` = orders, ``<seg> Revenue`` = exact cents sum,
    ``<seg> Lines Per Session`` = line items / orders, 2 decimals.
    Line items are counted per order first, so the big table is reduced
    before it meets orders.
    """
    lines = (table(spark, sf_dir, "lineitem").groupBy("l_orderkey")
             .agg(F.count(F.lit(1)).alias("n_lines")))
    oc = _orders_by_customer(spark, sf_dir)
    seg = (oc.join(lines, oc.o_orderkey == lines.l_orderkey, "left")
           .groupBy("Date", F.col("c_mktsegment").alias("seg"))
           .agg(F.count(F.lit(1)).alias("n_orders"),
                F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("revenue"),
                F.sum(F.coalesce("n_lines", F.lit(0))).alias("n_lines")))
    total, revenue, lps = SEGMENT_KINDS
    return seg.select("Date", F.explode(F.array(
        F.struct(F.concat_ws(" ", "seg", F.lit(total)).alias("Metric"),
                 F.col("n_orders").cast("double").alias("Value")),
        F.struct(F.concat_ws(" ", "seg", F.lit(revenue)).alias("Metric"),
                 F.col("revenue").cast("double").alias("Value")),
        F.struct(F.concat_ws(" ", "seg", F.lit(lps)).alias("Metric"),
                 round2(F.col("n_lines") / F.col("n_orders")).alias("Value")),
    )).alias("m")).select("Date", "m.Metric", "m.Value")


def customers_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fact_customers as (Date, Metric, Value): orders per customer per month."""
    return (_orders_by_customer(spark, sf_dir)
            .groupBy("Date", F.col("c_name").alias("Metric"))
            .agg(F.count(F.lit(1)).cast("double").alias("Value")))


def daily_customers_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per customer per day: several rows in a metric-month, copies, null values and names."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    kind = F.when(F.col("o_custkey") % 3 == 0, " Lines Per Session").otherwise(" Orders")
    return (o.join(c, o.o_custkey == c.c_custkey)
            .select(F.to_date("o_orderdate").alias("Date"),
                    F.when(F.col("o_orderkey") % 101 != 0, F.concat("c_name", kind)).alias("Metric"),
                    F.when(F.col("o_orderkey") % 7 != 0, (F.col("o_orderkey") % 5).cast("double") / 4).alias("Value")))


def to_fact(long_df: DataFrame, glossary: DataFrame) -> DataFrame:
    """(Date, Metric, Value) -> fact (fecha, metrica, valor) via the glossary."""
    return (names_to_ids(long_df, glossary)
            .select(F.col("Date").alias("fecha"), "metrica", F.col("Value").alias("valor")))


def segments_glossary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_glossary(segments_long(spark, sf_dir))


def segments_fact(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(fact_segments, its glossary), each computed once (many plans read both)."""
    g = materialize(segments_glossary(spark, sf_dir))
    return materialize(to_fact(segments_long(spark, sf_dir), g)), g


def segment_updates(fact: DataFrame, glossary: DataFrame) -> DataFrame:
    """fact_updates: two reloaded months with new values plus one new month.

    Orders and revenue of UPDATE_MONTHS get ``valor + 1`` (the lines metric
    is not re-sent); NEW_MONTH repeats every metric of NEW_MONTH_FROM.
    """
    kinds = glossary.where(~F.col("nombre").endswith(SEGMENT_KINDS[2])).select("metrica")
    months = F.trunc("fecha", "month").isin(*[F.lit(m) for m in UPDATE_MONTHS])
    changed = (fact.where(months).join(kinds, "metrica", "left_semi")
               .select("fecha", "metrica", (F.col("valor") + 1).alias("valor")))
    added = (fact.where(F.trunc("fecha", "month") == F.lit(NEW_MONTH_FROM))
             .select(F.lit(NEW_MONTH).alias("fecha"), "metrica", "valor"))
    return changed.unionByName(added)


def _pages_with_host(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages").select("page_id", "url")
    host = F.try_parse_url(F.col("url"), F.lit("HOST"))
    return p.select(
        "page_id",
        host.alias("host"),
        F.substring_index(host, ".", -1).alias("property"),
        F.substring_index(host, ".", 1).alias("site"),
        F.try_parse_url(F.col("url"), F.lit("PROTOCOL")).alias("scheme"))


def traffic_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """traffic_events: one row per event with its page's host.

    Event ``e`` is on page ``e.event_id % (number of pages)``. The property
    is the host's top-level label (three properties, like the reference's
    three sites); ``site`` is the host's first label.
    """
    n_pages = table(spark, sf_dir, "pages").count()
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    return (e.withColumn("page_id", F.col("event_id") % F.lit(n_pages))
            .join(_pages_with_host(spark, sf_dir), "page_id")
            .select("ts", "user_id", (F.col("event_type") == "view").alias("is_view"),
                    "host", "property", "site", "scheme"))


def page_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue of properties (sites the loader reports on)."""
    return _pages_with_host(spark, sf_dir).select("property").where(F.col("property").isNotNull()).distinct()


def traffic_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """traffic_sources: one view per event; the source is the event type."""
    return (table(spark, sf_dir, "events")
            .select("ts", F.col("event_type").alias("source"), F.lit(1).alias("views")))


def media_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """media_rows: one mention per document; a file per document source.

    Rating: toxic -> ``negativa``; else quality 1 -> ``positiva``, quality 0
    -> ``neutra``; no label -> null. Date text: MEDIA_FIRST_DAY plus
    ``doc_id % MEDIA_DAYS`` days.
    """
    d = table(spark, sf_dir, "documents").select("doc_id", "source")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    rating = (F.when(F.col("toxic") == 1, "negativa")
              .when(F.col("quality") == 1, "positiva")
              .when(F.col("quality") == 0, "neutra"))
    day = F.date_add(F.lit(MEDIA_FIRST_DAY), (F.col("doc_id") % MEDIA_DAYS).cast("int"))
    return (d.join(lab, "doc_id", "left")
            .select(F.col("source").alias("file"),
                    F.date_format(day, "yyyy-MM-dd").alias("Fecha"),
                    rating.alias("Calificacion")))


def dirty_media_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """media_rows as people type them: padded and capitalised ratings, dates that do not parse."""
    rows = media_rows(spark, sf_dir)
    day = F.dayofyear(F.to_date("Fecha"))
    pad = F.element_at(F.array(F.lit("\u00a0"), F.lit("\t "), F.lit("  "), F.lit("")), (day % 4 + 1).cast("int"))
    said = F.when(day % 3 == 0, F.upper("Calificacion")).when(day % 3 == 1, F.initcap("Calificacion")).otherwise(F.col("Calificacion"))
    date = (F.when(day % 13 == 0, F.lit("2024-02-30")).when(day % 13 == 1, F.concat(F.lit(" "), "Fecha"))
            .when(day % 13 == 2, F.lit("2024-1-5")).when(day % 13 == 3, F.concat("Fecha", F.lit(" 10:00")))
            .when(day % 13 != 4, F.col("Fecha")))
    return rows.select("file", date.alias("Fecha"), F.concat(pad, said, pad).alias("Calificacion"))


def file_number() -> Column:
    """``K`` of a file ``srcK``."""
    return F.coalesce(F.regexp_extract("file", "[0-9]+", 0).try_cast("int"), F.lit(0))


def positional_rows(spark: SparkSession, sf_dir: str, months_apart: int = 0) -> DataFrame:
    """Mention files as raw rows (file, pos, cells), a file per document source ``srcK``.

    ``K % 12`` rows stand before the header; its columns change with ``K``,
    and for ``K % 7 = 3`` the rating's column has another name. Dates are
    moved by ``months_apart`` months a file.
    """
    number = file_number()
    before = number % 12
    rating = F.when(number % 7 == 3, F.lit("Rating")).otherwise(F.lit("Calificación"))
    even = number % 2 == 0
    cells = lambda rate, date: F.when(even, F.array(F.lit("m"), rate, date)).otherwise(F.array(date, F.lit("m"), rate))
    files = table(spark, sf_dir, "documents").select(F.col("source").alias("file")).distinct()
    top = (files.select("file", F.explode(F.sequence(F.lit(0), before)).alias("pos"))
           .select("file", F.col("pos").cast("long").alias("pos"),
                   F.when(F.col("pos") == before, cells(rating, F.lit("Fecha")))
                   .otherwise(F.array(F.lit("Reporte"), F.lit(None).cast("string"), F.lit(None).cast("string"))).alias("cells")))
    moved = F.date_format(F.add_months(F.to_date("Fecha"), number * months_apart), "yyyy-MM-dd")
    rows = (media_rows(spark, sf_dir).withColumn("Fecha", moved).withColumn("_id", F.monotonically_increasing_id())
            .select("file", (before + 1 + F.col("_id")).alias("pos"), cells(F.col("Calificacion"), F.col("Fecha")).alias("cells")))
    return top.unionByName(rows)


HISTORY_MONTHS = 5      # month columns of a history file from ene-24 on


def history_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide history files as raw rows (file, pos, cells), one per document source ``srcK``.

    A document falls on column ``doc_id % HISTORY_MONTHS``: the first is
    ``ene-24``, the others the months that follow after ``K % 4`` more. An
    earlier month, a column that is no month and a fifth row stand around
    what is read; positive counts end in ``.9``, neutral ones of odd files
    are blank.
    """
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("file"))
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    rated = d.join(lab, "doc_id", "left").withColumn("j", F.col("doc_id") % HISTORY_MONTHS)
    toxic, quality = F.col("toxic") == 1, F.col("quality")
    kinds = [F.lit(True), ~F.coalesce(toxic, F.lit(False)) & (quality == 1), toxic,
             ~F.coalesce(toxic, F.lit(False)) & (quality == 0)]
    counts = rated.groupBy("file").agg(*[F.count_if((F.col("j") == j) & kind).cast("string").alias(f"c{j}_{k}")
                                         for j in range(HISTORY_MONTHS) for k, kind in enumerate(kinds)])
    shift = file_number() % 4
    month = lambda j: F.add_months(F.lit(MEDIA_FIRST_DAY), F.lit(0) if j == 0 else shift + j)
    label = lambda j: F.concat(spanish_month_label(F.month(month(j))), F.lit("-"), F.date_format(month(j), "yy"))
    blank = file_number() % 2 == 1

    def cell(j: int, k: int) -> Column:
        held = F.col(f"c{j}_{k}")
        return {1: F.concat(held, F.lit(".9")), 3: F.when(~blank, held)}.get(k, held)

    js = range(HISTORY_MONTHS)
    head = F.array(F.lit("Concepto"), F.lit("dic-23"), *[label(j) for j in js], F.lit("Nota"))
    body = [F.array(F.lit(name), F.lit("9"), *[cell(j, k) for j in js], F.lit("x")) for k, name in
            enumerate(("Total", "Positivas", "Negativas", "Neutras"))]
    rest = F.array(*[F.lit("7")] * (HISTORY_MONTHS + 3))
    return counts.select("file", F.posexplode(F.array(head, *body, rest)).alias("pos", "cells"))


def written_files(rows: DataFrame, folder: str) -> str:
    """Writes raw rows (file, pos, cells) as one CSV file each; the pattern that names the files."""
    lines = rows.select("file", "pos", F.array_join("cells", ",", "").alias("value"))
    (lines.repartition("file").sortWithinPartitions("file", "pos").select("file", "value")
     .write.partitionBy("file").text(folder))
    return f"{folder}/file=*/*.txt"


def file_of(path: str) -> Column:
    """The ``file`` that a path of ``written_files`` stands for."""
    return F.regexp_extract(path, "file=([^/]*)", 1)


__all__ = ["history_rows", "written_files", "file_of", "table", "segments_long", "customers_long", "to_fact", "segments_glossary",
           "segments_fact", "segment_updates", "traffic_events", "page_properties",
           "traffic_sources", "media_rows", "dirty_media_rows", "positional_rows", "daily_customers_long", "ADS_SOURCE"]
