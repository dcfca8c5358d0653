"""Golden cases for the comparison table (worked by hand from the report rules)."""

import datetime as dt

import pytest

from monthend.operators import compare as C

D = dt.date


def rows(spark, data):
    return spark.createDataFrame(data, "Date date, Metric string, Value double")


def result(df):
    return sorted(tuple(r) for r in df.collect())


SUM_CASE = [
    (D(2024, 7, 31), "A Views", 10.0), (D(2024, 8, 31), "A Views", 20.0),
    (D(2024, 9, 30), "A Views", 30.0), (D(2025, 7, 31), "A Views", 40.0),
    (D(2025, 8, 31), "A Views", 50.0), (D(2025, 9, 30), "A Views", None),
]
SUM_EXPECT = [
    (D(2024, 7, 31), "A Views", 10.0, 10.0, 0.0, 0.0, 0.0),
    (D(2024, 8, 31), "A Views", 20.0, 20.0, 0.0, 0.0, 10.0),
    (D(2024, 9, 30), "A Views", 30.0, 50.0, 0.0, 0.0, 10.0),
    (D(2025, 7, 31), "A Views", 40.0, 90.0, 10.0, 10.0, 10.0),
    (D(2025, 8, 31), "A Views", 50.0, 50.0, 20.0, 20.0, 90.0),
    (D(2025, 9, 30), "A Views", 0.0, 0.0, 30.0, 50.0, 90.0),
]
MEAN_CASE = [
    (D(2024, 8, 31), "A Views Per Session", 1.5), (D(2024, 9, 30), "A Views Per Session", 2.0),
    (D(2024, 10, 31), "A Views Per Session", None), (D(2024, 11, 30), "A Views Per Session", 2.5),
    (D(2025, 8, 31), "A Views Per Session", 3.0), (D(2025, 11, 30), "A Views Per Session", 4.0),
]
M = "A Views Per Session"
MEAN_EXPECT = [
    (D(2024, 8, 31), M, 1.5, 1.5, 0.0, 0.0, 0.0),
    (D(2024, 9, 30), M, 2.0, 1.75, 0.0, 0.0, 0.0),
    (D(2024, 10, 31), M, 0.0, 0.0, 0.0, 0.0, 0.0),
    (D(2024, 11, 30), M, 2.5, 1.5, 0.0, 0.0, 0.0),
    (D(2025, 8, 31), M, 3.0, 3.0, 1.5, 1.5, 2.0),
    (D(2025, 11, 30), M, 4.0, 3.5, 2.5, 1.5, 2.0),
]
DUP_CASE = [
    (D(2024, 8, 15), "D", 1.0), (D(2024, 8, 31), "D", 2.0),
    (D(2025, 8, 31), "D", 5.0), (D(2026, 8, 31), "D", 7.0),
]
DUP_EXPECT = [
    (D(2024, 8, 15), "D", 1.0, 1.0, 0.0, 0.0, 0.0),
    (D(2024, 8, 31), "D", 2.0, 3.0, 0.0, 0.0, 0.0),
    (D(2025, 8, 31), "D", 5.0, 5.0, 1.0, 1.0, 3.0),
    (D(2025, 8, 31), "D", 5.0, 5.0, 2.0, 3.0, 3.0),
    (D(2026, 8, 31), "D", 7.0, 7.0, 5.0, 5.0, 10.0),
]


@pytest.mark.parametrize("path", ["join", "window", "auto"])
def test_sum_metric(spark, path):
    assert result(C.compare_table(rows(spark, SUM_CASE), path=path)) == sorted(SUM_EXPECT)


@pytest.mark.parametrize("path", ["join", "window", "auto"])
def test_mean_metric(spark, path):
    assert result(C.compare_table(rows(spark, MEAN_CASE), path=path)) == sorted(MEAN_EXPECT)


@pytest.mark.parametrize("path", ["join", "auto"])
def test_duplicate_month_follows_reference(spark, path):
    assert result(C.compare_table(rows(spark, DUP_CASE), path=path)) == sorted(DUP_EXPECT)


def test_grain_check(spark):
    assert C.has_unique_grain(rows(spark, SUM_CASE))
    assert not C.has_unique_grain(rows(spark, DUP_CASE))


def test_rounding_half_even(spark):
    from pyspark.sql import functions as F
    from monthend.functions.numeric import round2
    df = spark.createDataFrame([(0.125,), (2.665,), (2.675,), (1.005,)], "x double")
    got = [r[0] for r in df.select(round2("x")).collect()]
    assert got == [0.12, 2.66, 2.68, 1.0]
    # Spark's own round is half-up: the reason for round2
    assert df.select(F.round("x", 2)).first()[0] == 0.13


def test_fiscal_year(spark):
    from monthend.functions.calendar import fiscal_year
    df = spark.createDataFrame([(D(2026, 3, 1),), (D(2024, 8, 1),), (D(2024, 7, 31),)], "d date")
    assert [r[0] for r in df.select(fiscal_year("d")).collect()] == [2025, 2024, 2023]


def test_null_date_and_metric_dropped(spark):
    df = spark.createDataFrame([(None, "A", 1.0), (D(2024, 8, 31), None, 2.0),
                                (D(2024, 8, 31), "A", 3.0)], "Date date, Metric string, Value double")
    assert C.compare_table(df, path="join").count() == 1


@pytest.mark.parametrize("path", ["window", "join"])
def test_slices(spark, path):
    df = rows(spark, SUM_CASE)
    a = result(C.analytics_slice(df, D(2025, 8, 1), path=path))
    assert a == [SUM_EXPECT[4]]
    c = result(C.current_slice(df, D(2025, 9, 1), path=path))
    assert c == [(D(2025, 9, 30), "A Views", 0.0, 90.0)]


def test_slice_auto_keeps_reference_numbers_with_duplicates(spark):
    # duplicates two fiscal years back inflate the previous FY (T4); auto must
    # see them and fall back to the join path
    df = rows(spark, DUP_CASE)
    got = result(C.analytics_slice(df, D(2026, 8, 1)))
    assert got == [DUP_EXPECT[4]]


def test_last_ytd_of_a_year_is_next_years_previous_fy(spark):
    # SURVEY §5 property: sum metrics, unique grain, no null values
    from monthend.sources import testdata as TD
    from pyspark.sql import Window, functions as F
    from monthend.functions.calendar import fiscal_year
    out = C.compare_table(TD.customers_long(spark, "/root/testdata/sf0.001"))
    out = out.withColumn("fy", fiscal_year("Date"))
    last = (out.withColumn("_rk", F.row_number().over(
        Window.partitionBy("Metric", "fy").orderBy(F.col("Date").desc())))
        .where("_rk = 1").select("Metric", (F.col("fy") + 1).alias("fy"), F.col("ytd").alias("last_ytd")))
    nxt = out.select("Metric", "fy", "Previous_FY_Value").distinct()
    joined = nxt.join(last, ["Metric", "fy"])
    assert joined.count() > 100
    assert joined.where("last_ytd <> Previous_FY_Value").count() == 0
