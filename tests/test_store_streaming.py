"""Fact store month-slice commits and the incremental (streaming) media load."""

import datetime as dt
import time

from monthend.plans.media_load import media_glossary_rows
from monthend.sources.store import FactStore
from monthend.streaming.media_folder import reject_path, start_media_folder_load

D = dt.date
FACT = "fecha date, metrica int, valor double"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_store_replace_and_upsert(spark, tmp_path):
    store = FactStore(spark, str(tmp_path / "fact"))
    base = spark.createDataFrame([(D(2024, 1, 31), 1, 1.0), (D(2024, 1, 31), 13, 5.0),
                                  (D(2024, 2, 29), 1, 2.0), (D(2023, 12, 31), 1, 3.0)], FACT)
    store.write_all(base)
    assert rows(store.read()) == rows(base)
    before = store.version().partitions["year=2023/month=12"]
    upd = spark.createDataFrame([(D(2024, 1, 31), 1, 10.0), (D(2024, 2, 29), 1, 20.0)], FACT)
    store.replace_months(upd)
    want = [(D(2023, 12, 31), 1, 3.0), (D(2024, 1, 31), 1, 10.0), (D(2024, 1, 31), 13, 5.0),
            (D(2024, 2, 29), 1, 20.0)]
    assert rows(store.read()) == want
    assert store.version().partitions["year=2023/month=12"] == before          # untouched partition
    store.replace_months(upd)
    assert rows(store.read()) == want
    store.upsert(spark.createDataFrame([(D(2024, 1, 31), 13, 6.0), (D(2024, 3, 31), 13, 1.0)], FACT))
    assert rows(store.read()) == sorted(want[:2] + [(D(2024, 1, 31), 13, 6.0), want[3],
                                                    (D(2024, 3, 31), 13, 1.0)])


def test_streaming_folder_load_is_incremental(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    (inbox / "jan.csv").write_text("x,,\nFecha,Calificación\n2024-01-03,positiva\n2024-01-04,neutra\n",
                                   encoding="utf-8")
    store = FactStore(spark, str(tmp_path / "fact"))
    glossary = media_glossary_rows(spark)
    ckpt = str(tmp_path / "ckpt")
    start_media_folder_load(spark, str(inbox), store, glossary, checkpoint=ckpt).awaitTermination()
    assert rows(store.read()) == [(D(2024, 1, 31), 13, 2.0), (D(2024, 1, 31), 14, 1.0),
                                  (D(2024, 1, 31), 15, 0.0), (D(2024, 1, 31), 16, 1.0)]
    time.sleep(1.1)
    (inbox / "jan_v2.csv").write_text("Fecha,Calificación\n2024-01-05,negativa\n", encoding="utf-8")
    (inbox / "feb.csv").write_text("Fecha,Calificación\n2024-02-05,positiva\n", encoding="utf-8")
    start_media_folder_load(spark, str(inbox), store, glossary, checkpoint=ckpt).awaitTermination()
    got = {(r.fecha, r.metrica): r.valor for r in store.read().collect()}
    # the newer January file replaces January; February is added
    assert got[(D(2024, 1, 31), 13)] == 1.0 and got[(D(2024, 1, 31), 15)] == 1.0
    assert got[(D(2024, 2, 29), 14)] == 1.0 and len(got) == 8
    start_media_folder_load(spark, str(inbox), store, glossary, checkpoint=ckpt).awaitTermination()
    assert len(store.read().collect()) == 8


def test_stream_records_files_it_cannot_load(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    (inbox / "bad.csv").write_text("Fecha,Rating\n2024-01-03,positiva\n", encoding="utf-8")
    (inbox / "good.csv").write_text('Titular,Fecha,Calificación\n"a ""b"", c",2024-01-03,positiva\n', encoding="utf-8")
    store = FactStore(spark, str(tmp_path / "fact"))
    start_media_folder_load(spark, str(inbox), store, media_glossary_rows(spark),
                            checkpoint=str(tmp_path / "ckpt")).awaitTermination()
    assert {r.metrica: r.valor for r in store.read().collect()} == {13: 1.0, 14: 1.0, 15: 0.0, 16: 0.0}
    bad = spark.read.parquet(reject_path(store)).collect()
    assert [(r.file.rsplit("/", 1)[1], "Calificación" in r.reason) for r in bad] == [("bad.csv", True)]


def test_report_from_store_prunes_and_matches(spark, tmp_path):
    import random
    from monthend.operators import compare as C
    from monthend.plans.report import report_from_store
    rnd = random.Random(7)
    data = []
    for y in range(2015, 2026):
        for m in range(1, 13):
            last = D(y + m // 12, m % 12 + 1, 1) - dt.timedelta(days=1)
            for mid in (1, 2):
                data.append((last, mid, float(rnd.randint(0, 100))))
    g = spark.createDataFrame([(1, "A Views"), (2, "B Views Per Session")], "metrica int, nombre string")
    store = FactStore(spark, str(tmp_path / "fact"))
    store.write_all(spark.createDataFrame(data, FACT))
    a, c = report_from_store(store, g, D(2025, 3, 15))
    full = C.compare_table(spark.createDataFrame(
        [(d, "A Views" if i == 1 else "B Views Per Session", v) for d, i, v in data],
        "Date date, Metric string, Value double"))
    want_a = full.where("Date = date'2025-02-28'")
    assert rows(a) == rows(want_a)
    assert rows(c) == rows(full.where("Date = date'2025-03-31'")
                           .select("Date", "Metric", "Value", "Previous_FY_Value"))
    plan = store.read_range(D(2022, 8, 1), D(2025, 3, 1))._jdf.queryExecution().executedPlan().toString()
    pf = plan[plan.index("PartitionFilters: ["):].split("]", 1)[0]
    assert "year" in pf and "month" in pf


def test_failed_reload_leaves_table_unchanged(spark, tmp_path):
    # The reference deleted the month before fetching; here a job that
    # fails while computing the new slice must not touch the table
    import pytest
    from pyspark.sql import functions as F
    store = FactStore(spark, str(tmp_path / "fact"))
    base = spark.createDataFrame([(D(2024, 1, 31), 1, 1.0), (D(2024, 2, 29), 1, 2.0)], FACT)
    store.write_all(base)
    bad = (spark.createDataFrame([(D(2024, 1, 31), 1, 0.0)], FACT)
           .withColumn("valor", F.assert_true(F.col("valor") > 0).cast("double") + F.col("valor")))
    with pytest.raises(Exception):
        store.replace_months(bad)
    assert rows(store.read()) == rows(base)


def test_empty_updates_are_a_no_op(spark, tmp_path):
    # An empty but valid input changes nothing
    store = FactStore(spark, str(tmp_path / "fact"))
    base = spark.createDataFrame([(D(2024, 1, 31), 1, 1.0)], FACT)
    store.write_all(base)
    empty = spark.createDataFrame([], FACT)
    store.replace_months(empty)
    store.upsert(empty)
    assert rows(store.read()) == rows(base)


def test_read_months_prunes_partitions(spark, tmp_path):
    store = FactStore(spark, str(tmp_path / "fact"))
    store.write_all(spark.createDataFrame([(D(2024, m, 28), 1, float(m)) for m in range(1, 13)], FACT))
    df = store.read_months([(2024, 3), (2024, 7)])
    assert rows(df) == [(D(2024, 3, 28), 1, 3.0), (D(2024, 7, 28), 1, 7.0)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    pf = plan[plan.index("PartitionFilters: ["):].split("]", 1)[0]
    assert "year" in pf and "month" in pf


def test_failed_tab_write_keeps_the_old_tab(spark, tmp_path):
    from pyspark.sql import functions as F

    from monthend.plans.report import write_tab
    from monthend.sources.versions import publish, published
    tab = str(tmp_path / "Current Month")
    old = spark.createDataFrame([(D(2024, 1, 31), "A", 1.0)], "Date date, Metric string, Value double")
    assert write_tab(old, tab)
    read = lambda: [tuple(r) for r in spark.read.option("header", True).csv(published(spark, tab)).collect()]
    for adaptive in ("true", "false"):
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        try:
            bad = old.withColumn("Value", F.when(F.col("Value") == 1.0, F.raise_error(F.lit("lost"))).cast("double"))
            for attempt in (lambda: write_tab(bad, tab),
                            lambda: publish(spark, tab, lambda staged: bad.write.csv(staged))):
                try:
                    attempt()
                    raise AssertionError("the write should have failed")
                except Exception as e:  # noqa: BLE001
                    assert "lost" in str(e)
                assert read() == [("2024-01-31", "A", "1.0")]
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert not write_tab(old.limit(0), tab)
    publish(spark, tab, lambda staged: old.selectExpr("Date", "Metric", "2 as Value").write.option("header", True).csv(staged))
    assert read() == [("2024-01-31", "A", "2")]


def test_properties_named_by_the_glossary(spark):
    from monthend.plans.monthly_load import glossary_properties
    names = ["a b Total Users", "a b Views", "a b Views Per Session", "c Views", "Video Total Views", "Video Organic Views",
             "Total Media Mentions"]
    g = spark.createDataFrame(list(enumerate(names, 1)), "metrica int, nombre string")
    assert sorted(r.property for r in glossary_properties(g).collect()) == ["a b", "c"]


def test_an_older_report_that_arrives_later_does_not_win(spark, tmp_path):
    """Order holds across runs, by the modification time that the commit records for each month."""
    import os
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    store = FactStore(spark, str(tmp_path / "fact"))
    glossary = media_glossary_rows(spark)
    text = "Fecha,Calificación\n" + "2024-01-05,positiva\n"

    def arrive(name, mtime, mentions):
        (inbox / name).write_text(text * 1 + "2024-01-06,neutra\n" * (mentions - 1), encoding="utf-8")
        os.utime(inbox / name, (mtime, mtime))
        start_media_folder_load(spark, str(inbox), store, glossary, checkpoint=str(tmp_path / "ckpt")).awaitTermination()
        return {r.metrica: r.valor for r in store.read().collect()}[13]

    assert arrive("b.csv", 2_000_000_000, 3) == 3.0
    before = store.version()
    assert arrive("z_older.csv", 1_900_000_000, 5) == 3.0 and store.version() == before
    assert arrive("a_newer.csv", 2_100_000_000, 2) == 2.0
