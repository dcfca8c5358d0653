"""Skew-proof prefix sums against a plain window."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from monthend.operators.lookup import number_rows
from monthend.operators.running import prefix_sums


def test_prefix_sums_match_window_with_a_hot_group(spark):
    rows = [("hot", i, float(i % 7)) for i in range(3000)]
    rows += [(f"g{k}", i, 1.5) for k in range(50) for i in range(5)]
    df = spark.createDataFrame(rows, "g string, o int, v double").repartition(5)
    got = prefix_sums(df, ["g"], [F.col("o")], {"s": F.col("v"), "n": F.lit(1).cast("long")}, partitions=16)
    w = Window.partitionBy("g").orderBy("o").rowsBetween(Window.unboundedPreceding, -1)
    want = df.select("g", "o", "v", F.coalesce(F.sum("v").over(w), F.lit(0.0)).alias("s"),
                     F.coalesce(F.count(F.lit(1)).over(w), F.lit(0)).alias("n"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    # the hot group really was spread over several ranges
    ranges = (df.repartitionByRange(16, "g", "o").withColumn("r", F.spark_partition_id())
              .where("g = 'hot'").select("r").distinct().count())
    assert ranges > 4


def test_ranges_stay_the_same_whatever_columns_are_read(spark):
    """Extra columns, many rows, exchange reuse off: numbers are 1..n and sums exact."""
    n = 300_000
    df = spark.range(n).select(F.hash("id").alias("k"), "id", F.lit("x" * 40).alias("extra"))
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        ids = number_rows(df, ["k", "id"], partitions=12)
        assert ids.select(F.count_distinct("row_id"), F.min("row_id"), F.max("row_id")).first() == (n, 1, n)
        got = prefix_sums(df.withColumn("g", F.lit(1)), ["g"], [F.col("id")], {"s": F.lit(1).cast("long")}, partitions=12)
        assert got.where(F.col("s") != F.col("id")).count() == 0
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
