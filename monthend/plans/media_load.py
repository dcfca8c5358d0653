"""Media loads: monthly mention files (Q6) and the wide history file (Q7)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthend.functions.text import spanish_month_label
from monthend.operators.lookup import names_to_ids
from monthend.operators.media import MEDIA_METRICS, last_report_per_month, mention_reports, report_rows
from monthend.operators.mutate import insert_ignore, upsert
from monthend.operators.reshape import history_updates
from monthend.session import materialize, scratch_path
from monthend.sources.files import read_history_files, read_mention_files
from monthend.sources.store import FactStore


def media_glossary_rows(spark: SparkSession) -> DataFrame:
    """The four media metrics with their seeded ids (13-16)."""
    return spark.createDataFrame(MEDIA_METRICS, "metrica int, nombre string")


def mention_updates(rows: DataFrame, glossary: DataFrame) -> DataFrame:
    """Q6 core: mention rows -> fact rows (fecha, metrica, valor, _order).

    When several files report one month, the last one wins as a whole: the
    one with the newest modification time, then the last by name. ``_order``
    orders it against reports loaded before (``upsert_in_order`` keeps it).
    """
    last = last_report_per_month(mention_reports(rows))
    order = F.col("mtime") if "mtime" in last.columns else F.col("file")
    m = report_rows(last).join(last.select("fecha", order.alias("_order")), "fecha")
    return names_to_ids(m, glossary).select("fecha", "metrica", "valor", "_order")


def upsert_in_order(store: FactStore, updates: DataFrame, name: str = "media") -> list[dt.date]:
    """Upserts reports (fecha, metrica, valor, _order timestamp) unless a newer one of the month was loaded before.

    The commit records, under ``name``, the order of the report each month
    holds (a number a month), so an older file that arrives in a later run
    does not replace a newer one. Returns the months that were left as they
    are.
    """
    updates = materialize(updates)
    held = store.version().properties.get("order", {})
    known = held.get(name, {})
    month = F.trunc("fecha", "month")
    newest = {r[0]: r[1] for r in updates.groupBy(month).agg(F.max(F.unix_micros("_order"))).collect()}
    taken = {m: o for m, o in newest.items() if o >= known.get(m.isoformat(), o)}
    if taken:
        ledger = {**known, **{m.isoformat(): o for m, o in taken.items()}}
        store.upsert(updates.where(month.isin(*taken)), order_col="_order", properties={"order": {**held, name: ledger}})
    return sorted(newest.keys() - taken.keys())


def refuse(rows: DataFrame, what: str, error: type[Exception] = ValueError) -> None:
    """Stop with an error if there are any rows; all of them are in the table it names."""
    first = [tuple(r) for r in rows.limit(5).collect()]
    if first:
        path = scratch_path(rows.sparkSession, "refused")
        rows.write.parquet(path)
        raise error(f"{what}: {rows.sparkSession.read.parquet(path).count()} in {path}, e.g. {first}")


def media_monthly_load(spark: SparkSession, path: str, target: DataFrame, glossary: DataFrame,
                       strict: bool = True) -> DataFrame:
    """Q6: every mention file under ``path`` -> upsert into ``target``.

    Files without the required columns are refused (C9); with ``strict`` the
    whole load stops before writing and names a table of them.
    """
    rows, invalid = read_mention_files(spark, path)
    if strict:
        refuse(invalid, "files lack the 'Calificación'/'Fecha' columns")
    return upsert(target, materialize(mention_updates(rows, glossary)), order_col="_order")


def media_history_load(spark: SparkSession, path: str, target: DataFrame,
                       glossary: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Q7: seed the glossary (B4), then upsert the unpivoted history files.

    ``path`` is a file, a folder or a pattern; each file has months of its
    own, and of files that name one month the newest wins. Returns (new fact
    table, new glossary). Cells that hold non-numeric text, month columns
    named twice and files without rows stop the load, which names a table of
    them.
    """
    rows, refused = read_history_files(spark, path)
    refuse(refused, "history cells, columns or files that cannot be loaded")
    new_glossary = insert_ignore(glossary, media_glossary_rows(spark))
    return upsert(target, materialize(history_updates(rows)), order_col="_order"), new_glossary


def history_frame(counts: DataFrame, month_col: str = "month") -> DataFrame:
    """A wide history frame from monthly counts (the layout the upload reads).

    ``counts``: (month, total, positive, negative, neutral, unrated). Rows by
    position: Total, Positivas, Negativas, Neutras, Sin calificar; one text
    column per month labelled ``mmm-yy``, in calendar order.
    """
    concepts = ["total", "positive", "negative", "neutral", "unrated"]
    long = (counts.select(
        F.concat(spanish_month_label(F.month(month_col)), F.lit("-"),
                 F.date_format(month_col, "yy")).alias("_label"),
        F.col(month_col).alias("_month"),
        F.posexplode(F.array(*[F.col(c).cast("string") for c in concepts])).alias("_row", "_text")))
    labels = [r._label for r in long.select("_label", "_month").distinct()
              .orderBy("_month").collect()]
    return (long.groupBy("_row").pivot("_label", labels).agg(F.first("_text"))
            .select("_row", *[F.col(f"`{c}`") for c in labels]))
