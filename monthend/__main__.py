"""Command-line jobs: ``python -m monthend <job> ...`` (or spark-submit this module).

| job | does | reference script it replaces |
|---|---|---|
| report | Analytics + Current Month tabs as CSV folders | the report updater |
| monthly-load | reload previous + current month of traffic metrics | the web/video extractor |
| backfill | reload every month from --start to --as-of | the historical repair |
| media-load | upsert every mention file of a folder | the monthly media extractor |
| media-history | seed the glossary, upsert wide history files | the media history upload |
| media-watch | the media load as a stream over an inbox folder | (incremental variant) |
| snapshot-upload | upsert finalized ``historical/`` snapshots, never ``staging/`` | the snapshot uploader of the older design notes |

Tables: the fact table is a ``FactStore`` folder; the glossary a Parquet
folder ``(metrica, nombre)``; traffic events Parquet with
``(ts, user_id, is_view, property[, scheme, site])``; traffic sources
Parquet with ``(ts, source, views)``; an optional effective-dated source
table ``(source_name, scheme, valid_from, valid_to, site_filter)``.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from monthend.session import checkpoint_dir, get_session, scratch_path


def _date(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def _replace_glossary(spark: SparkSession, path: str, new: DataFrame) -> None:
    """Write the new glossary beside the old one, then switch (never overwrite what is read)."""
    from monthend.sources.store import publish
    publish(spark, path, lambda staged: new.write.parquet(staged))


def run(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    p = argparse.ArgumentParser(prog="monthend")
    sub = p.add_subparsers(dest="job", required=True)
    for name in ("report", "monthly-load", "backfill", "media-load", "media-history", "media-watch",
                 "snapshot-upload"):
        s = sub.add_parser(name)
        s.add_argument("--fact", required=True, help="fact table folder")
        s.add_argument("--glossary", required=True, help="glossary Parquet folder")
        if name == "report":
            s.add_argument("--as-of", type=_date, required=True)
            s.add_argument("--target-month", help="YYYY-MM (manual mode); default: month before --as-of")
            s.add_argument("--out", required=True, help="folder for the two tabs")
        if name in ("monthly-load", "backfill"):
            s.add_argument("--events", required=True)
            s.add_argument("--sources", required=True)
            s.add_argument("--as-of", type=_date, required=True)
            s.add_argument("--ads-source", default="ADVERTISING")
            s.add_argument("--properties", help="Parquet catalogue (property); default: those the glossary names")
            s.add_argument("--cutover", help="Parquet table (source_name, scheme, valid_from, "
                                             "valid_to, site_filter) for an effective-dated property")
            s.add_argument("--cutover-name", help="property name reported from --cutover")
        if name == "backfill":
            s.add_argument("--start", type=_date, required=True)
            s.add_argument("--months-per-commit", type=int, default=12,
                           help="a run that died skips the months it committed when it is run again")
        if name == "media-load":
            s.add_argument("--files", required=True)
            s.add_argument("--split-files", action="store_true",
                           help="read big files in parallel blocks (no field spans lines)")
        if name == "media-history":
            s.add_argument("--file", required=True)
        if name == "media-watch":
            s.add_argument("--inbox", required=True)
            s.add_argument("--continuous", action="store_true")
            s.add_argument("--checkpoint", help="stream progress folder (default: under the "
                                                 "shared checkpoint folder, one per inbox)")
        if name == "snapshot-upload":
            s.add_argument("--root", required=True, help="folder holding historical/ and staging/")
    a = p.parse_args(argv)

    spark = spark or get_session()
    checkpoint_dir(spark)
    from monthend.sources.store import FactStore, published
    store = FactStore(spark, a.fact)
    glossary = spark.read.parquet(published(spark, a.glossary))

    if a.job == "report":
        from monthend.plans.report import report_from_store, write_tab
        analytics, current = report_from_store(store, glossary, a.as_of, a.target_month)
        write_tab(analytics, f"{a.out.rstrip('/')}/Analytics")
        write_tab(current, f"{a.out.rstrip('/')}/Current Month")
    elif a.job in ("monthly-load", "backfill"):
        from monthend.operators.lookup import missing_names
        from monthend.plans import monthly_load as Q
        events = spark.read.parquet(a.events)
        sources = spark.read.parquet(a.sources)
        props = (spark.read.parquet(a.properties).select("property") if a.properties
                 else Q.glossary_properties(glossary))
        cutover = (a.cutover_name, spark.read.parquet(a.cutover)) if a.cutover else None
        named = props if cutover is None else props.unionByName(spark.createDataFrame([(a.cutover_name,)], "property string"))
        missing = scratch_path(spark, "missing-metrics")
        missing_names(Q.traffic_metric_names(named), glossary).write.parquet(missing)    # reads the catalogue, not the events
        names = spark.read.parquet(missing)
        if not names.isEmpty():
            print(f"{names.count()} metrics not in the glossary (skipped), all in {missing}, "
                  f"e.g. {[r.Metric for r in names.orderBy('Metric').limit(5).collect()]}")
        load = {"ads_source": a.ads_source, "cutover": cutover}
        if a.job == "monthly-load":
            print(Q.monthly_load_store(store, glossary, events, sources, props, a.as_of, **load))
        else:
            Q.backfill_store(store, glossary, events, sources, props, a.start, a.as_of, a.months_per_commit, **load)
    elif a.job == "media-load":
        from monthend.plans.media_load import mention_updates, refuse, upsert_in_order
        from monthend.sources.files import read_mention_files
        rows, invalid = read_mention_files(spark, a.files, multiline=not a.split_files)
        refuse(invalid, "files lack the 'Calificación'/'Fecha' columns", SystemExit)
        older = upsert_in_order(store, mention_updates(rows, glossary))
        if older:
            print(f"months that hold a newer report already were left as they are: {older}")
    elif a.job == "media-history":
        from monthend.operators.mutate import insert_ignore
        from monthend.operators.reshape import history_updates
        from monthend.plans.media_load import media_glossary_rows, refuse
        from monthend.sources.files import read_history_files
        rows, refused = read_history_files(spark, a.file)
        refuse(refused, "history cells, columns or files that cannot be loaded", SystemExit)
        _replace_glossary(spark, a.glossary, insert_ignore(glossary, media_glossary_rows(spark)))
        store.upsert(history_updates(rows), order_col="_order")
    elif a.job == "media-watch":
        from monthend.streaming.media_folder import start_media_folder_load
        q = start_media_folder_load(spark, a.inbox, store, glossary, checkpoint=a.checkpoint,
                                    trigger="processing_time" if a.continuous else "available_now")
        q.awaitTermination()
    elif a.job == "snapshot-upload":
        from monthend.plans.report import load_snapshots
        load_snapshots(store, a.root, glossary)


if __name__ == "__main__":
    run()
