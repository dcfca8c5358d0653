"""User states: merged days equal the report from raw events; runs read new days only; sketch error."""

import datetime as dt
import random

import pytest

from monthend.operators import traffic as T
from monthend.operators import user_states as S

D, TS = dt.date, dt.datetime
EVENTS = "ts timestamp_ntz, user_id long, is_view boolean, property string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def made_events(spark, rng, n=1500):
    """Visits that run over midnight and over month ends, gaps of exactly the limit, null users, repeats."""
    out = []
    for _ in range(n // 5):
        user, site = rng.choice([None, *range(25)]), rng.choice(["a", "b", None])
        at = TS(2023, 12, 1) + dt.timedelta(minutes=rng.choice([rng.randrange(70 * 1440), 1440 * rng.randrange(70) - rng.randrange(30)]))
        for _ in range(5):
            out.append((at, user, rng.random() < 0.6, site))
            at += dt.timedelta(minutes=rng.choice([0, 5, 29, 30, 31]), microseconds=rng.choice([0, 0, 1]))
    return spark.createDataFrame(out, EVENTS)


@pytest.mark.parametrize("seed", [1, 2])
def test_merged_days_equal_the_report(spark, seed):
    events = made_events(spark, random.Random(seed)).cache()
    days = S.daily_states(events, ["property"]).cache()
    assert rows(S.report_from_states(days, ["property"], "month")) == rows(T.traffic_report(events, ["property"]))
    weeks = S.merge_states(days.withColumn("month", days.day.substr(1, 7)), ["property", "month"], "week")
    again = S.report_from_states(weeks.drop("day").selectExpr("*", "to_date(concat(month, '-01')) AS day"), ["property"], "month")
    assert rows(again) == rows(T.traffic_report(events, ["property"]))      # states of states


def test_runs_read_new_days_only(spark, tmp_path, monkeypatch):
    events = made_events(spark, random.Random(7), 600).where("ts < timestamp_ntz'2024-01-20'").cache()
    states = S.TrafficStates(spark, str(tmp_path / "states"), {"property": "string"})
    ranges, plain = [], S.in_date_range
    monkeypatch.setattr(S, "in_date_range", lambda ts, a, b: ranges.append((a, b)) or plain(ts, a, b))
    runs = [D(2023, 12, 20), D(2024, 1, 3), D(2024, 1, 20)]
    for as_of in runs:
        states.advance(events.where(plain("ts", "2000-01-01", as_of)), as_of, D(2023, 11, 30))
    assert ranges == [(D(2023, 11, 30), runs[0]), (runs[0], runs[1]), (runs[1], runs[2])]
    assert rows(states.report()) == rows(T.traffic_report(events, ["property"]))
    january = states.report("month", D(2024, 1, 1), D(2024, 1, 31))
    assert rows(january) == rows(T.traffic_report(events.where("ts >= timestamp_ntz'2024-01-01'"), ["property"]))
    kept = states.table.version().partitions
    gone = events.where("not (ts >= timestamp_ntz'2024-01-04' and ts < timestamp_ntz'2024-01-05')")
    states.load(gone, D(2024, 1, 4), D(2024, 1, 4))       # a day whose events were withdrawn
    assert "day_number=20240104" not in states.table.version().partitions and len(kept) - len(states.table.version().partitions) <= 1
    assert rows(states.report()) == rows(T.traffic_report(gone, ["property"]))
    assert states.loaded_to() == runs[2]


def test_scan_is_cut_to_the_new_days(spark, tmp_path):
    path = str(tmp_path / "events")
    made_events(spark, random.Random(8), 100).write.parquet(path)
    read = spark.read.parquet(path).where(T.in_date_range("ts", D(2024, 1, 3), D(2024, 1, 4)))
    plan = S.daily_states(read, ["property"])._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):].split("]")[0]
    assert "GreaterThanOrEqual(ts" in pushed and "LessThan(ts" in pushed


def test_error_of_the_sketches(spark):
    """Forty thousand users over thirty days: within three times the stated error, and exact days stay far larger."""
    users = spark.range(40_000).selectExpr("id AS user_id", "explode(sequence(0, 29)) AS d").where("hash(user_id, d) % 3 = 0")
    days = users.selectExpr("'a' AS property", "user_id", "date_add(date'2024-01-01', d) AS day")
    sketches = S.daily_sketches(days, ["property"])
    (got,) = S.users_from_sketches(sketches, ["property"]).collect()
    want = days.select("user_id").distinct().count()
    assert abs(got.users - want) / want < 3 * 1.04 / (2 ** S.LG_K) ** 0.5
    assert max(len(r.sketch) for r in sketches.collect()) < 2 ** (S.LG_K + 1)
