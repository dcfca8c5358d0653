"""Connected components of a link table, by alternating large and small stars.

Each round links every node's larger neighbours to its smallest one, then all
its neighbours to the smallest; rounds grow with the logarithm of a
component's size. The links stay distributed and each round is cut off by a
reliable checkpoint; only counts reach the driver.
"""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthend.session import materialize


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files and checkpoints of steps that nothing refers to any more.

    It does so when the driver's JVM collects its garbage, which a loop of
    small steps on large data may not bring about for long.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` of every node with a link; ``component`` is its smallest reachable node."""
    stars = materialize(links.select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi"))
                        .where(F.col("lo") < F.col("hi")).distinct())
    while True:
        both = stars.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            stars.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where(F.col("v") > F.col("u")).join(least, "u")
                 .select(F.col("m").alias("lo"), F.col("v").alias("hi")))
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (large.join(least, "hi")
                 .select("m", F.explode(F.array("lo", "hi")).alias("hi"))
                 .where(F.col("hi") > F.col("m")).select(F.col("m").alias("lo"), "hi").distinct())
        stars = materialize(small)
        # done when every node has one centre and no centre has another
        roles = stars.select(F.explode(F.array(F.struct(F.col("hi").alias("node"), F.lit(1).alias("ray")),
                                               F.struct(F.col("lo").alias("node"), F.lit(0).alias("ray")))).alias("r"))
        several = roles.groupBy("r.node").agg(F.sum("r.ray").alias("rays"), F.min("r.ray").alias("least"))
        done = several.where((F.col("rays") > 1) | (F.col("rays") > 0) & (F.col("least") == 0)).isEmpty()
        del both, least, large, small, roles, several
        release(stars.sparkSession)
        if done:
            break
    roots = stars.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return stars.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(roots)


def merged(component: DataFrame, links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` after further links; only the components they touch are gone through."""
    of = lambda end: component.select(F.col("node").alias(end), F.col("component").alias(f"of_{end}"))
    between = links.join(of(a), a, "left").join(of(b), b, "left").select(
        F.coalesce(f"of_{a}", a).alias("a"), F.coalesce(f"of_{b}", b).alias("b"))
    moved = connected_components(between).withColumnsRenamed({"node": "was", "component": "now"})
    old = component.join(moved, F.col("component") == F.col("was"), "left").select(
        "node", F.coalesce("now", "component").alias("component"))
    new = moved.join(component, F.col("was") == F.col("node"), "left_anti").select(
        F.col("was").alias("node"), F.col("now").alias("component"))
    return materialize(old.unionByName(new))
