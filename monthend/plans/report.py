"""The two-tab report (Q2, Q3) and its file sinks.

The reference publishes two spreadsheet tabs; here each tab is a CSV folder
(header + rows, dates as ``YYYY-MM-DD``, nulls as 0) written in the report
order. Writing goes to a fresh folder and is switched in only after the job
committed, so a failed run leaves the previous report in place.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthend.functions.calendar import (fiscal_year_of, fiscal_year_start, next_month,
                                         report_months)
from monthend.operators.compare import (CURRENT_COLUMNS, REPORT_COLUMNS, analytics_slice, compare_table,
                                        current_slice, has_unique_grain, sort_report)
from monthend.operators.lookup import ids_to_names, names_to_ids
from monthend.session import materialize
from monthend.sources.files import list_snapshots, read_snapshots, snapshot_hashes
from monthend.sources.store import publish


def report_frames(report_input: DataFrame, as_of, target_month: str | None = None,
                  path: str = "auto") -> tuple[DataFrame, DataFrame]:
    """(Analytics tab, Current Month tab) for ``as_of`` (K6 modes)."""
    if isinstance(as_of, str):
        as_of = dt.date.fromisoformat(as_of)
    analytics, current = report_months(as_of, target_month)
    return (analytics_slice(report_input, analytics, path=path),
            current_slice(report_input, current, path=path))


def report_from_store(store, glossary: DataFrame, as_of, target_month: str | None = None
                      ) -> tuple[DataFrame, DataFrame]:
    """Q2 + Q3 from one comparison over the fact partitions they need.

    Each tab needs its month, its fiscal year so far and the whole previous
    fiscal year; the grain check looks one more fiscal year back (see
    ``compare.month_slice``). Both tabs are cut from one comparison over the
    union of their ranges, whose two months are stored, so that writing the
    tabs computes nothing again. Older partitions are neither listed nor
    read: the window path reads two fiscal years, the join path (duplicate
    months) three.
    """
    if isinstance(as_of, str):
        as_of = dt.date.fromisoformat(as_of)
    months = report_months(as_of, target_month)
    first_fy = min(fiscal_year_of(m) for m in months)
    last_upper = max(next_month(m) for m in months)
    probe = ids_to_names(store.read_range(fiscal_year_start(first_fy - 2), last_upper), glossary)
    path = "window" if has_unique_grain(probe) else "join"
    lower = fiscal_year_start(first_fy - (1 if path == "window" else 2))
    table = compare_table(ids_to_names(store.read_range(lower, last_upper), glossary), path=path)
    either = [(F.col("Date") >= F.lit(m)) & (F.col("Date") < F.lit(next_month(m))) for m in months]
    both = materialize(table.where(either[0] | either[1]))
    return both.where(either[0]).select(*REPORT_COLUMNS), both.where(either[1]).select(*CURRENT_COLUMNS)


def to_sheet(df: DataFrame) -> DataFrame:
    """B5 formatting: ``Date`` as text, nulls as 0, report order."""
    out = df.withColumn("Date", F.date_format("Date", "yyyy-MM-dd"))
    return sort_report(out.na.fill(0))


def write_tab(df: DataFrame, path: str) -> bool:
    """Replace a tab; an empty frame writes nothing and keeps the old tab.

    The rows are computed once and stored, so the test for emptiness does not
    compute them again; the new folder is switched in after its job committed
    (``versions.published`` tells which folder holds the tab).
    Returns whether a new tab was written.
    """
    rows = materialize(df)
    if rows.isEmpty():
        return False
    publish(df.sparkSession, path, lambda staged: to_sheet(rows).write.option("header", True).csv(staged))
    return True


def write_snapshot(df: DataFrame, root: str, mode: str, as_of) -> str:
    """B6 (older design notes): route a run's rows by mode.

    ``current`` overwrites the single staging folder; ``historical`` writes a
    dated ``historical/results_YYYY-MM-DD.csv`` folder that A7 reads back.
    """
    if isinstance(as_of, str):
        as_of = dt.date.fromisoformat(as_of)
    root = root.rstrip("/")
    if mode == "current":
        path = f"{root}/staging/current_month_progress"
    elif mode == "historical":
        path = f"{root}/historical/results_{as_of.isoformat()}.csv"
    else:
        raise ValueError(f"unknown mode {mode!r}")
    (df.select(F.col("Date").cast("date"), "Metric", F.col("Value").cast("double"))
     .write.mode("overwrite").option("header", True).csv(path))
    return path


def snapshot_updates(spark, root: str, glossary: DataFrame, only: list[str] | None = None) -> DataFrame:
    """A7 -> fact rows: finalized snapshots only (``staging`` is never read).

    Returns (fecha, metrica, valor, _order) with the snapshot date as the
    upsert order, so a later snapshot of the same month wins.
    """
    snaps, rejected = read_snapshots(spark, root, only=only)
    if rejected:
        print(f"{len(rejected)} snapshot paths without a date or under staging were not read: {rejected}")
    return (names_to_ids(snaps, glossary)
            .select(F.col("Date").alias("fecha"), "metrica", F.col("Value").alias("valor"),
                    F.col("snapshot_date").alias("_order")))


def load_snapshots(store, root: str, glossary: DataFrame) -> list[str]:
    """Upserts the snapshots that are new or changed since the last load; the paths that were read.

    The commit holds a ledger of the snapshots taken: date, length, newest
    change and a fingerprint of their lines. One whose length and change time
    are as before is not opened; one with other times is fingerprinted, and
    loaded only if its lines differ. As the latest snapshot of a month wins,
    those dated after the earliest one to be loaded are loaded with it. A
    replay changes nothing.
    """
    spark = store.spark
    listed, _ = list_snapshots(spark, root)
    ledger = store.version().properties.get("snapshots", {})
    same = lambda p: all(ledger.get(p, {}).get(k) == listed[p][k] for k in ("length", "changed"))
    opened = [p for p in listed if not same(p)]
    hashes = snapshot_hashes(spark, opened) if opened else {}
    now = {p: {**f, "hash": hashes.get(p) or ledger[p]["hash"]} for p, f in listed.items()}
    changed = [p for p in opened if ledger.get(p, {}).get("hash") != now[p]["hash"]]
    if not changed:
        if now != ledger:
            store.table.commit(store.version(), {}, {"snapshots": now})
        return []
    first = min(now[p]["date"] for p in changed)
    read = [p for p in now if now[p]["date"] >= first]
    store.upsert(snapshot_updates(spark, root, glossary, only=read), order_col="_order", properties={"snapshots": now})
    return read
