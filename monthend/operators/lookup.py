"""Glossary lookups: ids for names (D2), missing names (D3), skipped ids (C11).

The glossary ``(metrica int, nombre string)`` is a dimension. It is small in
the reference (16 rows) but grows with the number of metrics (one per
customer, say), so no join here forces a broadcast: Catalyst and AQE
broadcast it when its measured size is under the threshold and fall back to
a shuffle join beyond it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from monthend.operators.running import stored_ranges


def number_rows(df: DataFrame, order_by: list[str], col: str = "row_id",
                start: int = 1, partitions: int | None = None) -> DataFrame:
    """Global 1-based row number in ``order_by`` order, without one-task windows.

    A global ``row_number()`` moves every row into one task. Here rows are
    range-partitioned on the order key (stored once, so that all that follows
    sees the same ranges), numbered inside each range, and offset by the row
    counts of the earlier ranges. The offset table has one
    row per range, so broadcasting it is bounded by the partition count.
    Ties in ``order_by`` are numbered in an arbitrary but fixed order.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = stored_ranges(df, n, *order_by)
    local = ranged.withColumn(
        "_local", F.row_number().over(Window.partitionBy("_range").orderBy(*order_by)))
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select(
        "_range",
        F.coalesce(F.sum("_n").over(Window.orderBy("_range")
                                    .rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_offset"))
    return (local.join(F.broadcast(offsets), "_range")
            .withColumn(col, F.col("_offset") + F.col("_local") + F.lit(start - 1).cast("long"))
            .drop("_range", "_local", "_offset"))


def build_glossary(names: DataFrame, name_col: str = "Metric") -> DataFrame:
    """Glossary with ids 1..n in name order, from any frame of names."""
    distinct = names.select(F.col(name_col).alias("nombre")).where(F.col("nombre").isNotNull()).distinct()
    ids = number_rows(distinct, ["nombre"], col="metrica")
    return ids.select(F.col("metrica").cast("int").alias("metrica"), "nombre")


def glossary_map(glossary: DataFrame) -> DataFrame:
    """A1: name -> id; on duplicate names the last (highest) id wins."""
    return (glossary.where(F.col("nombre").isNotNull())
            .groupBy("nombre").agg(F.max("metrica").alias("metrica")))


def names_to_ids(long_df: DataFrame, glossary: DataFrame, name_col: str = "Metric") -> DataFrame:
    """D2 + C11: replace the metric name by its glossary id.

    Names absent from the glossary, or mapped to a null or 0 id, are skipped,
    as the loaders skip falsy ids.
    """
    g = glossary_map(glossary).withColumnRenamed("nombre", name_col)
    return (long_df.join(g, name_col, "inner")
            .where(F.col("metrica").isNotNull() & (F.col("metrica") != 0))
            .drop(name_col))


def missing_names(names: DataFrame, glossary: DataFrame, name_col: str = "Metric") -> DataFrame:
    """D3: distinct names that have no glossary entry (reported, not loaded)."""
    g = glossary.select(F.col("nombre").alias(name_col))
    return names.select(name_col).distinct().join(g, name_col, "left_anti")


def ids_to_names(fact: DataFrame, glossary: DataFrame) -> DataFrame:
    """Fact (fecha, metrica, valor) -> (Date, Metric, Value).

    Inner join on the id, so facts whose id is not in the glossary drop out;
    rows with a null name are dropped (C3).
    """
    return (fact.join(glossary.select("metrica", "nombre"), "metrica", "inner")
            .select(F.col("fecha").cast("date").alias("Date"),
                    F.col("nombre").alias("Metric"),
                    F.col("valor").cast("double").alias("Value"))
            .where(F.col("Metric").isNotNull()))
