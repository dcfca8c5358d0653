"""Media-mention counts per file (E4, E5, C8, J1, J4) and their metric rows.

Input rows: ``(file, Fecha string, Calificacion string)``, one per mention,
for any number of files; each file is one monthly report. All work is
``groupBy(file)`` aggregation, which combines map-side, so a file holding a
third of all rows is no hotter than any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthend.functions.calendar import last_day_of
from monthend.functions.text import clean_label, parse_iso_date

# Rating labels after lower-case + strip.
POSITIVE, NEGATIVE, NEUTRAL = "positiva", "negativa", "neutra"

# Glossary names of the four media metrics and the ids the
# history upload seeds for them.
MEDIA_METRICS = [
    (13, "Total Media Mentions"),
    (14, "Positive Media Mentions"),
    (15, "Negative Media Mentions"),
    (16, "Neutral Media Mentions"),
]


def mention_counts(rows: DataFrame, file: str = "file",
                   rating: str = "Calificacion") -> DataFrame:
    """Per file: every row, and rows rated positive/negative/neutral.

    Every row counts in the total, including unknown ratings, missing
    ratings and bad dates, so total >= the sum of the three parts.
    """
    r = clean_label(F.col(rating))
    return (rows.groupBy(F.col(file).alias("file"))
            .agg(F.count(F.lit(1)).alias("total"),
                 F.count_if(r == POSITIVE).alias("positive"),
                 F.count_if(r == NEGATIVE).alias("negative"),
                 F.count_if(r == NEUTRAL).alias("neutral")))


def report_month(rows: DataFrame, file: str = "file", date: str = "Fecha") -> DataFrame:
    """E5: the month a file reports on, as its last day.

    The most frequent year and the most frequent month are taken
    *separately* (ties go to the smaller value), so the pair need not occur
    in the file (T7). Dates that do not parse strictly are ignored; a file
    with no parseable date gets no row (nothing is loaded for it).
    """
    d = parse_iso_date(F.col(date))
    return (rows.select(F.col(file).alias("file"), d.alias("_d"))
            .where(F.col("_d").isNotNull())
            .groupBy("file")
            .agg(F.mode(F.year("_d"), True).alias("_y"), F.mode(F.month("_d"), True).alias("_m"))
            .select("file", last_day_of(F.col("_y"), F.col("_m")).alias("fecha")))


def mention_reports(rows: DataFrame, file: str = "file", rating: str = "Calificacion",
                    date: str = "Fecha") -> DataFrame:
    """Q6 core: per file its month and counts, in one aggregation.

    ``file, fecha, total, positive, negative, neutral`` and, if the rows carry
    the file's modification time, ``mtime``. Files without a parseable date
    are left out.
    """
    r, d = clean_label(F.col(rating)), parse_iso_date(F.col(date))
    order = [F.max("mtime").alias("mtime")] if "mtime" in rows.columns else []
    agg = rows.groupBy(F.col(file).alias("file")).agg(
        F.mode(F.year(d), True).alias("_y"), F.mode(F.month(d), True).alias("_m"),
        F.count(F.lit(1)).alias("total"), F.count_if(r == POSITIVE).alias("positive"),
        F.count_if(r == NEGATIVE).alias("negative"), F.count_if(r == NEUTRAL).alias("neutral"), *order)
    return agg.where(F.col("_y").isNotNull()).withColumn("fecha", last_day_of(F.col("_y"), F.col("_m"))).drop("_y", "_m")


def last_report_per_month(reports: DataFrame) -> DataFrame:
    """Of several files that report one month the last whole file: by ``mtime``, then by name."""
    last = [c for c in ("mtime", "file") if c in reports.columns]
    rest = [c for c in reports.columns if c not in ("fecha", *last)]
    one = reports.groupBy("fecha").agg(F.max(F.struct(*last, *rest)).alias("_r"))
    return one.select("fecha", "_r.*")


def report_rows(reports: DataFrame) -> DataFrame:
    """Per report four rows (file, fecha, Metric, valor)."""
    names = dict(MEDIA_METRICS)
    return (reports.select("file", "fecha", F.explode(F.array(
                *[F.struct(F.lit(names[i]).alias("Metric"), F.col(c).cast("double").alias("valor"))
                  for i, c in zip((13, 14, 15, 16), ("total", "positive", "negative", "neutral"))]
            )).alias("m"))
            .select("file", "fecha", "m.Metric", "m.valor"))


def mention_metrics(rows: DataFrame, file: str = "file", rating: str = "Calificacion",
                    date: str = "Fecha") -> DataFrame:
    """Q6 core: per file, four rows (file, fecha, Metric, valor)."""
    return report_rows(mention_reports(rows, file, rating, date))
