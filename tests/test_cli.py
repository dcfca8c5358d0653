"""Command-line jobs end to end on small tables."""

import datetime as dt

from monthend.__main__ import run
from monthend.sources.store import FactStore, published

D = dt.date
TS = dt.datetime


def test_cli_jobs(spark, tmp_path):
    fact, gl = str(tmp_path / "fact"), str(tmp_path / "glossary")
    spark.createDataFrame([(1, "a Total Users"), (2, "a Views"), (3, "a Views Per Session"),
                           (4, "Video Total Views")], "metrica int, nombre string").write.parquet(gl)
    ev, src = str(tmp_path / "events"), str(tmp_path / "sources")
    spark.createDataFrame([(TS(2024, 1, 5, 10), 1, True, "a"), (TS(2023, 12, 5, 10), 2, True, "a")],
                          "ts timestamp_ntz, user_id long, is_view boolean, property string").write.parquet(ev)
    spark.createDataFrame([(TS(2024, 1, 5), "X", 3)], "ts timestamp_ntz, source string, views int").write.parquet(src)
    run(["backfill", "--fact", fact, "--glossary", gl, "--events", ev, "--sources", src,
         "--as-of", "2024-01-20", "--start", "2023-12-01"], spark)
    run(["monthly-load", "--fact", fact, "--glossary", gl, "--events", ev, "--sources", src,
         "--as-of", "2024-01-20"], spark)
    got = {(r.fecha, r.metrica): r.valor for r in FactStore(spark, fact).read().collect()}
    assert got == {(D(2023, 12, 31), 1): 1.0, (D(2023, 12, 31), 2): 1.0, (D(2023, 12, 31), 3): 1.0,
                   (D(2023, 12, 31), 4): 0.0, (D(2024, 1, 20), 1): 1.0, (D(2024, 1, 20), 2): 1.0,
                   (D(2024, 1, 20), 3): 1.0, (D(2024, 1, 20), 4): 3.0}
    hist = tmp_path / "hist.csv"
    hist.write_text("Concepto,ene-24\nTotal,4\nPositivas,1\nNegativas,2\nNeutras,1\n", encoding="utf-8")
    run(["media-history", "--fact", fact, "--glossary", gl, "--file", str(hist)], spark)
    assert spark.read.parquet(published(spark, gl)).count() == 8
    files = tmp_path / "mentions"
    files.mkdir()
    (files / "a.csv").write_text("Fecha,Calificación\n2024-01-02,positiva\n", encoding="utf-8")
    run(["media-load", "--fact", fact, "--glossary", gl, "--files", str(files)], spark)
    got = {(r.fecha, r.metrica): r.valor for r in FactStore(spark, fact).read().collect()}
    assert got[(D(2024, 1, 31), 13)] == 1.0 and got[(D(2024, 1, 31), 15)] == 0.0
    out = tmp_path / "report"
    run(["report", "--fact", fact, "--glossary", gl, "--as-of", "2024-02-10", "--out", str(out)], spark)
    tab = spark.read.option("header", True).csv(published(spark, str(out / "Analytics"))).collect()
    assert {r.Metric for r in tab} >= {"a Views", "Total Media Mentions"}
    assert not (out / "Current Month").exists()          # empty month: nothing written


def test_snapshot_upload_ignores_staging(spark, tmp_path):
    from monthend.plans.report import write_snapshot
    fact, gl = str(tmp_path / "fact"), str(tmp_path / "glossary")
    spark.createDataFrame([(1, "A Views")], "metrica int, nombre string").write.parquet(gl)
    snap = spark.createDataFrame([(D(2024, 1, 31), "A Views", 5.0), (D(2024, 1, 31), "Unknown", 1.0)],
                                 "Date date, Metric string, Value double")
    root = str(tmp_path / "snaps")
    write_snapshot(snap, root, "historical", D(2024, 2, 1))
    write_snapshot(snap.selectExpr("Date", "Metric", "Value * 10 AS Value"), root, "historical", D(2024, 2, 5))
    write_snapshot(snap.selectExpr("Date", "Metric", "Value * 100 AS Value"), root, "current", D(2024, 2, 9))
    run(["snapshot-upload", "--fact", fact, "--glossary", gl, "--root", root], spark)
    assert [tuple(r) for r in FactStore(spark, fact).read().collect()] == [(D(2024, 1, 31), 1, 50.0)]


def test_media_watch_job(spark, tmp_path):
    fact, gl = str(tmp_path / "fact"), str(tmp_path / "glossary")
    from monthend.plans.media_load import media_glossary_rows
    media_glossary_rows(spark).write.parquet(gl)
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    (inbox / "m.csv").write_text("Fecha,Calificación\n2024-05-02,negativa\n2024-05-03,neutra\n", encoding="utf-8")
    run(["media-watch", "--fact", fact, "--glossary", gl, "--inbox", str(inbox),
         "--checkpoint", str(tmp_path / "ckpt")], spark)
    got = {(r.fecha, r.metrica): r.valor for r in FactStore(spark, fact).read().collect()}
    assert got == {(D(2024, 5, 31), 13): 2.0, (D(2024, 5, 31), 14): 0.0,
                   (D(2024, 5, 31), 15): 1.0, (D(2024, 5, 31), 16): 1.0}


def test_monthly_load_with_cutover(spark, tmp_path):
    fact, gl = str(tmp_path / "fact"), str(tmp_path / "glossary")
    spark.createDataFrame([(1, "Careers Total Users"), (2, "Careers Views")],
                          "metrica int, nombre string").write.parquet(gl)
    ev, src, cut = str(tmp_path / "events"), str(tmp_path / "sources"), str(tmp_path / "cut")
    spark.createDataFrame([(TS(2024, 1, 5, 10), 1, True, "com", "http", "blog"),
                           (TS(2024, 1, 6, 10), 2, True, "net", "https", "www")],
                          "ts timestamp_ntz, user_id long, is_view boolean, property string, "
                          "scheme string, site string").write.parquet(ev)
    spark.createDataFrame([], "ts timestamp_ntz, source string, views int").write.parquet(src)
    spark.createDataFrame([("old", "http", D(1900, 1, 1), D(2024, 1, 15), "blog"),
                           ("new", "https", D(2024, 1, 15), D(9999, 12, 31), None)],
                          "source_name string, scheme string, valid_from date, valid_to date, "
                          "site_filter string").write.parquet(cut)
    run(["monthly-load", "--fact", fact, "--glossary", gl, "--events", ev, "--sources", src,
         "--as-of", "2024-01-10", "--cutover", cut, "--cutover-name", "Careers"], spark)
    got = {(r.fecha, r.metrica): r.valor for r in FactStore(spark, fact).read().collect()}
    # period end 2024-01-10 is before the cutover: the old source (http, blog) counts
    assert got[(D(2024, 1, 10), 1)] == 1.0 and got[(D(2024, 1, 10), 2)] == 1.0
