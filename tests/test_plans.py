"""Plan-shape guards: the scale properties the README claims."""

import datetime as dt

from monthend.operators import compare as C
from monthend.operators import traffic as T

D = dt.date


def shuffles(df):
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning") + plan.count("Exchange rangepartitioning")


def sorts(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Sort [")


def facts(spark, dup=False):
    rows = [(D(2020 + y, m, 28), f"M{k}", float(k + m)) for k in range(5) for y in range(4) for m in range(1, 13)]
    if dup:
        rows += rows[:10]
    return spark.createDataFrame(rows, "Date date, Metric string, Value double")


def test_window_plan_one_shuffle_one_sort(spark):
    df = C.compare_window(facts(spark))
    assert shuffles(df) == 1
    assert sorts(df) == 1


def test_parity_plan_never_pairs_for_the_fiscal_year(spark):
    """The FY total comes from totals per metric-month; only the output is paired."""
    df = C.compare_join(facts(spark, dup=True))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("(Metric") > 0
    joins = [line for line in plan.splitlines() if "Join LeftOuter" in line and "_mo" in line]
    pairings = [line for line in joins if "_i#" in line and "_j#" in line]
    assert len(pairings) == 2  # once in each branch of the expansion, over the same exchanges
    # the others look up one row a month, by salt: the parts of crowded months
    assert all("_salt" in line for line in joins if line not in pairings)


def test_traffic_report_shuffles_buckets_not_events(spark):
    ev = spark.createDataFrame([(dt.datetime(2024, 1, 1, h, mi), u, True, "p")
                                for h in range(3) for mi in range(0, 60, 7) for u in range(4)],
                               "ts timestamp_ntz, user_id long, is_view boolean, property string")
    df = T.traffic_report(ev, ["property"])
    plan_before = df._jdf.queryExecution().executedPlan().toString()
    assert shuffles(df) == 3
    # the first shuffle is fed by a partial aggregate (map-side combine)
    assert "partial_min" in plan_before or "partial_max" in plan_before
