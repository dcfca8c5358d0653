"""As-of joins and overlap sweeps against plain loops, with one key holding nearly all rows."""

import bisect
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from monthend.operators import asof as A
from monthend.operators import traffic as T
from monthend.operators.running import prefix_max

D = dt.date


def day(n):
    return D(2020, 1, 1) + dt.timedelta(days=n)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_as_of_against_a_search(spark, seed):
    rng = random.Random(seed)
    key = lambda: rng.choice(["hot"] * 8 + ["a", "b", None])
    right = [(key(), rng.choice([None, *map(day, range(0, 300, 2))]), rng.randrange(50)) for _ in range(120)]
    left = [(i, key(), rng.choice([None, *map(day, range(300))])) for i in range(400)] + [(0, "hot", day(7))] * 3
    got = A.as_of(spark.createDataFrame(left, "id int, k string, asked date"),
                  spark.createDataFrame(right, "k string, since date, v int"), ["k"], "asked", "since", ["v"])
    want = []
    for i, k, t in left:
        fits = [(s, v) for kk, s, v in right if kk is not None and kk == k and s and t and s <= t]
        want.append((i, k, t, *(max(fits) if fits else (None, None))))
    assert rows(got) == sorted(want, key=str)
    assert A.as_of(spark.createDataFrame([], "id int, k string, asked date"),
                   spark.createDataFrame(right, "k string, since date, v int"), ["k"], "asked", "since", ["v"]).count() == 0


def test_as_of_of_a_million_rows_under_one_key(spark):
    """No task gets the key: its rows lie in several ranges."""
    right = spark.range(1_000_000).selectExpr("'k' AS k", "id * 3 AS since", "id AS v")
    left = spark.range(100_000).selectExpr("'k' AS k", "id * 29 AS asked")
    got = A.as_of(left, right, ["k"], "asked", "since", ["v"])
    assert got.where("v <> least(asked div 3, 999999) or v is null").isEmpty() and got.count() == 100_000
    ranged = prefix_max(right, ["k"], ["since"], {"m": F.col("since")}, partitions=8)
    assert ranged.select(F.spark_partition_id().alias("p")).distinct().count() > 1
    assert ranged.where("not (m <=> if(since = 0, null, since - 3))").isEmpty()


@pytest.mark.parametrize("small", [A.SMALL, 0])
def test_overlaps_against_all_pairs(spark, monkeypatch, small):
    monkeypatch.setattr(A, "SMALL", small)
    rng = random.Random(9)
    table = [(rng.choice(["x", "y", None]), f"s{i}", day(rng.randrange(200)), day(rng.randrange(200)), rng.choice([None, "p", "q"]))
             for i in range(60)]
    table = [(k, n, a, rng.choice([None, a, min(b, a + dt.timedelta(days=20)), a + dt.timedelta(days=9)]), s) for k, n, a, b, s in table]
    frame = spark.createDataFrame(table, "k string, name string, start date, stop date, scope string")
    got = {r.name for r in A.overlaps(frame, ["k"], "start", "stop", "name", "scope").collect()}
    good = sorted((r for r in table if r[0] and r[3] and r[2] < r[3]), key=lambda r: (r[2], r[3], r[1]))
    want = {b[1] for i, b in enumerate(good) for a in good[:i]
            if a[0] == b[0] and b[2] < a[3] and (a[4] is None or b[4] is None or a[4] == b[4])}
    assert got == want and want
    plain = {b[1] for i, b in enumerate(good) for a in good[:i] if a[0] == b[0] and b[2] < a[3]}
    assert {r.name for r in A.overlaps(frame, ["k"], "start", "stop", "name").collect()} == plain


def test_source_choice_of_a_large_table(spark):
    """The as-of plan keeps the same events as the join; sites, gaps and open ends included."""
    rng = random.Random(5)
    table, at = [], 0
    for i in range(60):
        width = rng.choice([1, 5, 30])
        sites = rng.choice([[None], ["p", "q"]])
        table += [(f"s{i}{s}", "http", day(at), day(at + width), s) for s in sites]
        at += width + rng.choice([0, 0, 3])
    table.append(("other", "https", D(1900, 1, 1), D(9999, 12, 31), None))
    events = spark.createDataFrame(
        [(i, rng.choice(["http", "https", "ftp", None]), rng.choice(["p", "q", "r", None]), day(rng.randrange(at))) for i in range(800)],
        "id int, scheme string, site string, period_end date")
    cutover = T.cutover_table(spark, table)
    joined, looked_up = T.choose_source(events, cutover), T.choose_source(events, cutover, small=0)
    assert sorted(joined.columns) == sorted(looked_up.columns)
    assert rows(looked_up.select(joined.columns)) == rows(joined) and joined.count() > 100


def test_a_clash_among_many_sources_is_refused(spark):
    starts = [day(i) for i in range(2000)]
    table = [(f"s{i}", "http", a, a + dt.timedelta(days=1), None) for i, a in enumerate(starts)]
    assert T.checked_cutover(T.cutover_table(spark, table)).count() == 2000
    at = bisect.bisect(starts, day(700))
    with pytest.raises(ValueError, match="overlap"):
        T.checked_cutover(T.cutover_table(spark, [*table, ("late", "http", starts[at], starts[at] + dt.timedelta(days=1), "p")]))
