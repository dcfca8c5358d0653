"""Running totals that do not put a hot group in one task.

``Window.partitionBy(g).orderBy(o)`` sends every row of a group to one
task. Here rows are range-partitioned on ``(g, o)`` instead -- Spark samples
the keys, so a group holding a third of the table is spread over many
ranges. Sampling again could draw other bounds, so every row's range number
is computed once and stored with it in the checkpoint folder; all that
follows reads the stored number. Each range computes its own running totals, and the total a group
carried in from earlier ranges is added back. Only the first group of a
range can have started in an earlier range, so the carry table has at most
one row per range and is broadcast with a bound of the partition count.

Rows with equal ``(g, o)`` keys stay in one range (a range partitioner
never splits equal keys), so callers should make the order unique -- e.g.
collapse identical rows first and order by every column, as the comparison
table does.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from monthend.session import materialize


def stored_ranges(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """``df`` in ``n`` ranges of ``order``, with the number of each row's range as ``_range``.

    The result is stored: evaluating it twice gives the same ranges.
    """
    return materialize(df.repartitionByRange(n, *order).withColumn("_range", F.spark_partition_id()))


def prefix_sums(df: DataFrame, group: list[str], order: list[Column | str],
                values: dict[str, Column], partitions: int | None = None) -> DataFrame:
    """Add, per row, the sums of ``values`` over the earlier rows of its group.

    ``values`` maps an output column name to the expression to sum; rows
    with no earlier row get 0 (cast to the expression's type).
    """
    def put_together(local: Column, carried: Column, kind: DataType) -> Column:
        zero = F.lit(0).cast(kind)
        return F.coalesce(local, zero) + F.coalesce(carried, zero)

    return _prefix(df, group, order, values, F.sum, put_together, partitions)


def prefix_max(df: DataFrame, group: list[str], order: list[Column | str],
               values: dict[str, Column], partitions: int | None = None) -> DataFrame:
    """Add, per row, the largest of ``values`` over the earlier rows of its group (null: none).

    With a struct that begins with the ordering column this is the last
    earlier row that has a value. Group columns must not be null.
    """
    return _prefix(df, group, order, values, F.max, lambda local, carried, _: F.greatest(local, carried), partitions)


def _prefix(df: DataFrame, group: list[str], order: list[Column | str], values: dict[str, Column],
            total: Callable[[str], Column], put_together: Callable[[Column, Column, DataType], Column],
            partitions: int | None) -> DataFrame:
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = df.withColumns({f"_v_{k}": v for k, v in values.items()})
    ranged = stored_ranges(keyed, n, *group, *order)
    before = (Window.partitionBy("_range", *group).orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, -1))
    local = ranged.withColumns({f"_l_{k}": total(f"_v_{k}").over(before) for k in values})
    totals = ranged.groupBy("_range", *group).agg(*[total(f"_v_{k}").alias(f"_t_{k}") for k in values])
    earlier = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carry = (totals.select("_range", *group, F.count(F.lit(1)).over(earlier).alias("_ranges"),
                           *[total(f"_t_{k}").over(earlier).alias(f"_c_{k}") for k in values])
             .where(F.col("_ranges") > 0).drop("_ranges"))
    out = local.join(F.broadcast(carry), ["_range", *group], "left")
    return out.select(
        *df.columns,
        *[put_together(F.col(f"_l_{k}"), F.col(f"_c_{k}"), keyed.schema[f"_v_{k}"].dataType).alias(k) for k in values])
