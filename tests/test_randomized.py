"""Randomized checks of mutations and sessions against plain-Python statements."""

import datetime as dt
import random

import pytest

from monthend.operators import mutate as U
from monthend.operators import traffic as T

D = dt.date
FACT = "fecha date, metrica int, valor double"


def rand_fact(rnd, n):
    rows = {}
    for _ in range(n):
        d = D(2024, rnd.randint(1, 6), 1)
        d = D(d.year + d.month // 12, d.month % 12 + 1, 1) - dt.timedelta(days=rnd.choice([1, 5]))
        rows[(d, rnd.randint(1, 8))] = float(rnd.randint(0, 50))
    return [(k[0], k[1], v) for k, v in rows.items()]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_replace_and_upsert_against_python(spark, seed):
    rnd = random.Random(seed)
    target, updates = rand_fact(rnd, 80), rand_fact(rnd, 15)
    months = {(d.year, d.month) for d, _, _ in updates}
    ids = {m for _, m, _ in updates}
    want_replace = sorted([r for r in target if not ((r[0].year, r[0].month) in months and r[1] in ids)]
                          + updates)
    t, u = spark.createDataFrame(target, FACT), spark.createDataFrame(updates, FACT)
    assert sorted(map(tuple, U.replace_months(t, u).collect())) == want_replace
    keys = {(d, m) for d, m, _ in updates}
    want_upsert = sorted([r for r in target if (r[0], r[1]) not in keys] + updates)
    assert sorted(map(tuple, U.upsert(t, u).collect())) == want_upsert


def sessions_python(events, gap=dt.timedelta(minutes=30)):
    out = {}
    by_user = {}
    for ts, user, view in sorted(events, key=lambda e: (e[1], e[0])):
        by_user.setdefault(user, []).append((ts, view))
    for user, evs in by_user.items():
        prev = None
        for ts, view in evs:
            month = D(ts.year, ts.month, 1)
            o = out.setdefault(month, [set(), 0, 0])
            o[0].add(user)
            o[1] += int(view)
            if prev is None or ts - prev >= gap or (prev.year, prev.month) != (ts.year, ts.month):
                o[2] += 1  # every month stands alone
            prev = ts
    return {m: (len(u), v, s) for m, (u, v, s) in out.items()}


@pytest.mark.parametrize("seed", [4, 5])
def test_sessions_against_python(spark, seed):
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 31, 22, 0)
    events = []
    for user in range(6):
        t = base + dt.timedelta(minutes=rnd.randint(0, 60))
        for _ in range(rnd.randint(5, 40)):
            step = rnd.choice([0, 1, 29, 30, 31, 45, 90, 29.999])
            t = t + dt.timedelta(minutes=step)
            events.append((t, user, rnd.random() < 0.5))
    df = spark.createDataFrame([(t, u, v, "p") for t, u, v in events],
                               "ts timestamp_ntz, user_id long, is_view boolean, property string")
    got = {r.period_start: (r.users, r.views, r.sessions)
           for r in T.traffic_report(df, ["property"], "month").collect()}
    assert got == sessions_python(events)


@pytest.mark.parametrize("zone", ["UTC", "Asia/Kathmandu"])
def test_any_window_of_months_gives_the_same_closed_months(spark, zone):
    """Reload and backfill agree on every month, also where zones are off the half hour."""
    from monthend.plans import monthly_load as Q
    rnd = random.Random(9)
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        events = []
        for user in range(5):
            t = dt.datetime(2024, 1, 28, 20, 0)
            for _ in range(160):
                t += dt.timedelta(minutes=rnd.choice([5, 20, 29, 31, 200, 900]))
                events.append((t.isoformat(" "), user, True, "p"))
        text = "ts string, user_id long, is_view boolean, property string"
        ev = spark.createDataFrame(events, text).selectExpr("cast(ts as timestamp) ts", "user_id", "is_view", "property")
        src = ev.selectExpr("ts", "'click' as source", "1 as views")
        props = spark.createDataFrame([("p",)], "property string")
        seen = {}
        for start, as_of in ((D(2024, 1, 1), D(2024, 4, 30)), (D(2024, 2, 1), D(2024, 4, 10)), (D(2024, 3, 1), D(2024, 4, 1))):
            rows = Q.traffic_metric_rows(ev, src, props, Q.backfill_months(start, as_of), as_of)
            for r in rows.collect():
                if r.fecha < as_of:  # closed months
                    assert seen.setdefault((r.fecha, r.Metric), r.valor) == r.valor
        assert len(seen) > 12
        first = [e for e in events if e[0] < "2024-02-01"]
        assert seen[D(2024, 1, 31), "p Views"] == len(first)
        assert seen[D(2024, 1, 31), "p Total Users"] == len({e[1] for e in first})
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
