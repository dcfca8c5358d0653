"""Scalar functions (J, K families)."""

import datetime as dt

from pyspark.sql import functions as F

from monthend.functions import calendar as K
from monthend.functions import numeric as N
from monthend.functions import text as X

D = dt.date


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_calendar_expressions(spark):
    r = one(spark,
            K.last_day_of(2024, 2).alias("leap"),
            K.previous_month(D(2025, 1, 15)).alias("prev"),
            K.period_end(F.lit(D(2025, 1, 1)), D(2025, 1, 15)).alias("running"),
            K.period_end(F.lit(D(2024, 12, 1)), D(2025, 1, 15)).alias("closed"),
            K.month_index(F.lit(D(2025, 1, 31))).alias("mi"),
            K.two_digit_year(F.lit("24")).alias("yy"))
    assert (r.leap, r.prev, r.running, r.closed) == (D(2024, 2, 29), D(2024, 12, 1), D(2025, 1, 15), D(2024, 12, 31))
    assert r.mi == 2025 * 12 and r.yy == 2024
    assert K.fiscal_year_of(D(2026, 3, 1)) == 2025 and K.fiscal_year_start(2024) == D(2024, 8, 1)
    assert K.next_month(D(2024, 12, 1)) == D(2025, 1, 1)
    assert K.add_months_py(D(2024, 1, 1), -13) == D(2022, 12, 1)


def test_fiscal_year_start_is_a_parameter(spark):
    r = one(spark, K.fiscal_year(F.lit(D(2024, 3, 1)), start_month=1).alias("a"),
            K.fiscal_year(F.lit(D(2024, 3, 1)), start_month=4).alias("b"))
    assert (r.a, r.b) == (2024, 2023)


def test_numeric_helpers(spark):
    r = one(spark, N.text_to_int(F.lit("24.9")).alias("a"), N.text_to_int(F.lit("-3.7")).alias("b"),
            N.text_to_int(F.lit("1,234")).alias("c"), N.zero_if_null(F.lit(None).cast("double")).alias("d"),
            N.safe_ratio(F.lit(5), F.lit(0)).alias("e"), N.safe_ratio(F.lit(5), F.lit(2)).alias("f"))
    assert (r.a, r.b, r.c, r.d, r.e, r.f) == (24, -3, None, 0.0, None, 2.5)


def test_exact_sum_is_order_independent(spark):
    vals = [0.1] * 10 + [0.2] * 10 + [1e9, -1e9]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    a = df.repartition(7).agg(N.as_double(N.exact_sum("v"))).first()[0]
    b = df.coalesce(1).agg(N.as_double(N.exact_sum("v"))).first()[0]
    assert a == b == 3.0


def test_text_helpers(spark):
    r = one(spark, X.spanish_month_number(F.lit("Ago")).alias("m"),
            X.spanish_month_number(F.lit("xyz")).alias("bad"),
            X.spanish_month_label(F.lit(12)).alias("lab"),
            X.clean_label(F.lit(" NEUTRA ")).alias("c"),
            X.contains(F.lit("A Views Per Session"), "Session").alias("s1"),
            X.contains(F.lit("A session"), "Session").alias("s2"))
    assert (r.m, r.bad, r.lab, r.c, r.s1, r.s2) == (8, None, "dic", "neutra", True, False)


def test_round2_equals_numpy_round_on_random_values(spark):
    import numpy as np
    rng = np.random.default_rng(3)
    xs = np.concatenate([rng.uniform(-1e4, 1e4, 5000), rng.integers(0, 100000, 2000) / 1000.0,
                         np.array([0.125, 2.665, 2.675, 1.005, -0.125, 0.005])])
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    got = [r[0] for r in df.select(N.round2("x")).collect()]
    assert got == [float(v) for v in np.round(xs, 2)]


def test_checkpoint_folder_comes_from_the_session(spark):
    from monthend.session import checkpoint_dir, scratch_path
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    d = checkpoint_dir(spark)
    assert configured is None or configured.rstrip("/").endswith(d.split(":", 1)[-1].rstrip("/")) \
        or d.rstrip("/").endswith(configured.split(":", 1)[-1].rstrip("/"))
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(d) and b.startswith(d)


def test_calendar_expressions_against_python(spark):
    import calendar as pycal
    import random
    rnd = random.Random(11)
    dates = [D(1995, 1, 1) + dt.timedelta(days=rnd.randint(0, 12000)) for _ in range(3000)]
    as_of = D(2010, 6, 15)
    df = spark.createDataFrame([(d,) for d in dates], "d date")
    got = df.select("d", K.fiscal_year("d").alias("fy"), K.month_start("d").alias("ms"),
                    K.period_end(K.month_start("d"), as_of).alias("pe"),
                    K.last_day_of(F.year("d"), F.month("d")).alias("ld"),
                    K.month_index("d").alias("mi")).collect()
    for r in got:
        d = r.d
        last = D(d.year, d.month, pycal.monthrange(d.year, d.month)[1])
        assert r.fy == (d.year if d.month >= 8 else d.year - 1)
        assert r.ms == d.replace(day=1) and r.ld == last
        assert r.pe == min(last, as_of)
        assert r.mi == d.year * 12 + d.month - 1
