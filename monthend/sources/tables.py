"""Fact and glossary tables from any Spark source (A1, A2).

The reference reads both from a relational database. Here a table is a
``spark.read`` call: Parquet or CSV paths, or ``format="jdbc"`` with the
usual ``url``/``dbtable``/``user``/``password`` options (a JDBC driver jar
must be on the classpath; none is in this environment, so that path is not
exercised by the tests). Only the needed columns are selected, so a
columnar source reads nothing else and a JDBC source pushes the projection
into its query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from monthend.operators.lookup import ids_to_names
from monthend.operators.mutate import as_fact


def read_table(spark: SparkSession, location: str | None = None, format: str = "parquet",
               **options: str) -> DataFrame:
    reader = spark.read.format(format)
    if format == "csv":
        reader = reader.option("header", True)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(location) if location else reader.load()


def read_glossary(spark: SparkSession, location: str | None = None, format: str = "parquet",
                  **options: str) -> DataFrame:
    """A1: (metrica int, nombre string)."""
    g = read_table(spark, location, format, **options)
    return g.selectExpr("CAST(metrica AS INT) AS metrica", "CAST(nombre AS STRING) AS nombre")


def read_fact(spark: SparkSession, location: str | None = None, format: str = "parquet",
              **options: str) -> DataFrame:
    """The fact table (fecha date, metrica int, valor double)."""
    return as_fact(read_table(spark, location, format, **options))


def report_source(fact: DataFrame, glossary: DataFrame) -> DataFrame:
    """A2: the report's input (Date, Metric, Value)."""
    return ids_to_names(fact, glossary)
