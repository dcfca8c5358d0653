"""Loads on disk: resumable backfill, counters of the load job, ledger of snapshots."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from monthend.operators import lookup as L
from monthend.plans import monthly_load as Q
from monthend.plans import report as P
from monthend.sources.store import FactStore

D, TS = dt.date, dt.datetime


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def traffic(spark):
    rng = random.Random(3)
    events = spark.createDataFrame(
        [(TS(2023, 9, 20) + dt.timedelta(minutes=rng.randrange(130 * 1440)), rng.choice([None, 1, 2, 3]), rng.random() < 0.5,
          rng.choice(["a", "b", "c", None])) for _ in range(400)], "ts timestamp_ntz, user_id long, is_view boolean, property string")
    sources = spark.createDataFrame(
        [(TS(2023, 9, 20) + dt.timedelta(minutes=rng.randrange(130 * 1440)), rng.choice(["ADVERTISING", "x", None]), rng.randrange(9))
         for _ in range(200)], "ts timestamp_ntz, source string, views int")
    props = spark.createDataFrame([("a",), ("b",)], "property string")
    glossary = L.build_glossary(Q.traffic_metric_names(props).where("Metric <> 'b Views'"))
    return events.cache(), sources.cache(), props, glossary


START, AS_OF = D(2023, 10, 1), D(2024, 1, 17)


def test_a_backfill_that_died_computes_only_the_rest(spark, tmp_path, monkeypatch, traffic):
    events, sources, props, glossary = traffic
    empty = spark.createDataFrame([], "fecha date, metrica int, valor double")
    want = rows(Q.backfill(empty, glossary, events, sources, props, START, AS_OF))
    store = FactStore(spark, str(tmp_path / "fact"))
    store.write_all(spark.createDataFrame([(D(2023, 10, 5), 1, 99.0), (D(2023, 10, 31), 77, 5.0)], "fecha date, metrica int, valor double"))
    computed, plain = [], Q.traffic_metric_rows

    def watched(ev, src, pr, months, as_of, **kw):
        computed.append(months)
        if len(computed) == 3:
            raise RuntimeError("killed")
        return plain(ev, src, pr, months, as_of, **kw)

    monkeypatch.setattr(Q, "traffic_metric_rows", watched)
    args = (store, glossary, events, sources, props, START, AS_OF)
    with pytest.raises(RuntimeError, match="killed"):
        Q.backfill_store(*args, months_per_commit=1)
    assert store.version().properties["backfill"]["months"] == ["2023-10-01", "2023-11-01"]
    assert {r[0].month for r in rows(store.read())} == {10, 11}
    computed.append(None)
    assert Q.backfill_store(*args, months_per_commit=1) == [D(2023, 12, 1), D(2024, 1, 1)]
    assert computed[-2:] == [[D(2023, 12, 1)], [D(2024, 1, 1)]]
    assert rows(store.read()) == sorted([*want, (D(2023, 10, 31), 77, 5.0)], key=str)
    assert Q.backfill_store(*args, months_per_commit=1) == []
    assert len(Q.backfill_store(*args, months_per_commit=3, run="again")) == 4      # another run does it all
    assert rows(store.read()) == sorted([*want, (D(2023, 10, 31), 77, 5.0)], key=str)


def test_counters_of_the_load(spark, tmp_path, traffic):
    """Equal to a count of their own, stored with the commit, and no second scan of the events."""
    events, sources, props, glossary = traffic
    path = str(tmp_path / "events")
    events.write.parquet(path)
    store = FactStore(spark, str(tmp_path / "fact"))
    got = Q.monthly_load_store(store, glossary, spark.read.parquet(path), sources, props, AS_OF)
    inside = events.where("ts >= timestamp_ntz'2023-12-01' and ts < timestamp_ntz'2024-01-18'")
    assert got["events"] == {"rows": inside.count(), "without_property": inside.where("property is null").count(),
                             "without_user": inside.where("user_id is null").count()}
    assert got["sources"]["rows"] == sources.where("ts >= timestamp_ntz'2023-12-01' and ts < timestamp_ntz'2024-01-18'").count()
    assert got["metric_rows"] == {"rows": 2 * (2 * 3 + 3), "without_id": 2, "without_date": 0}
    assert store.version().properties["load"] == got
    assert rows(store.read()) == rows(Q.monthly_load(store.read().limit(0), glossary, events, sources, props, AS_OF))


def snapshot(spark, root, day, values):
    long = spark.createDataFrame([(D(2024, m, 28), name, float(v)) for m, name, v in values], "Date date, Metric string, Value double")
    P.write_snapshot(long, root, "historical", day)


def test_only_new_or_changed_snapshots_are_read(spark, tmp_path):
    root = str(tmp_path / "snap")
    glossary = spark.createDataFrame([(1, "A"), (2, "B")], "metrica int, nombre string")
    store = FactStore(spark, str(tmp_path / "fact"))
    values = lambda: {(r.fecha.month, r.metrica): r.valor for r in store.read().collect()}
    names = lambda paths: sorted(p[-14:-4] for p in paths)
    snapshot(spark, root, "2024-02-01", [(1, "A", 1), (1, "B", 2), (1, "none", 9)])
    snapshot(spark, root, "2024-03-01", [(1, "A", 10), (2, "A", 20)])
    P.write_snapshot(spark.createDataFrame([(D(2024, 3, 1), "A", -1.0)], "Date date, Metric string, Value double"), root, "current", "2024-03-05")
    os.makedirs(f"{root}/historical/results_undated.csv")
    assert names(P.load_snapshots(store, root, glossary)) == ["2024-02-01", "2024-03-01"]
    assert values() == {(1, 1): 10.0, (1, 2): 2.0, (2, 1): 20.0}
    before = store.version()
    assert P.load_snapshots(store, root, glossary) == [] and store.version() == before
    snapshot(spark, root, "2024-04-01", [(3, "A", 30)])
    assert names(P.load_snapshots(store, root, glossary)) == ["2024-04-01"]
    snapshot(spark, root, "2024-03-01", [(1, "A", 10), (2, "A", 20)])       # written again with the same lines
    assert P.load_snapshots(store, root, glossary) == []
    snapshot(spark, root, "2024-02-01", [(1, "A", 5), (1, "B", 7)])         # an old one corrected: later ones still win
    assert names(P.load_snapshots(store, root, glossary)) == ["2024-02-01", "2024-03-01", "2024-04-01"]
    assert values() == {(1, 1): 10.0, (1, 2): 7.0, (2, 1): 20.0, (3, 1): 30.0}
    assert sorted(f["date"] for f in store.version().properties["snapshots"].values()) == ["2024-02-01", "2024-03-01", "2024-04-01"]


def test_counters_need_no_rows(spark, tmp_path, traffic):
    events, sources, props, glossary = traffic
    store = FactStore(spark, str(tmp_path / "fact"))
    got = Q.monthly_load_store(store, glossary, events.where(F.lit(False)), sources, props, AS_OF)
    assert got["events"]["rows"] == 0 and got["metric_rows"]["rows"] == 18
