"""Counters of a load, taken by the job that loads.

A ``LoadReport`` attaches Spark observations to the frames of a load. They
are filled by whatever job first runs them, so nothing is scanned for the
report, and ``result`` is stored beside the table in the commit's properties.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from monthend.operators.lookup import glossary_map


class LoadReport:
    def __init__(self):
        self._parts: dict[str, tuple[Observation, list[str]]] = {}

    def watch(self, name: str, df: DataFrame, **counts: Column) -> DataFrame:
        """``df``, whose rows are counted as they pass: all of them, and those where each of ``counts`` holds."""
        self._parts[name] = Observation(name), ["rows", *counts]
        return df.observe(self._parts[name][0], F.count(F.lit(1)).alias("rows"),
                          *[F.count_if(c).alias(k) for k, c in counts.items()])

    def result(self) -> dict[str, dict[str, int]]:
        """The counters; waits for the job that fills them, so call it after the load's first action.

        Where the optimizer saw that a part is empty it leaves the part out
        together with its counters, which are 0 then.
        """
        out = {}
        for name, (part, columns) in self._parts.items():
            try:
                out[name] = dict(part.get)
            except Py4JJavaError:
                out[name] = dict.fromkeys(columns, 0)
        return out


def names_to_ids_counted(long_df: DataFrame, glossary: DataFrame, report: LoadReport) -> DataFrame:
    """``lookup.names_to_ids``, with the names it skips counted: absent ones and those with a null or 0 id (D3, C11)."""
    joined = long_df.join(glossary_map(glossary).withColumnsRenamed({"nombre": "Metric"}), "Metric", "left")
    skipped = F.col("metrica").isNull() | (F.col("metrica") == 0)
    watched = report.watch("metric_rows", joined, without_id=skipped, without_date=F.col("fecha").isNull())
    return watched.where(~skipped & F.col("fecha").isNotNull())
