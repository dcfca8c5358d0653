"""Fact-table mutations as DataFrame operators.

There is no transactional table format in this environment (no MERGE), so
each mutation is an anti-join plus a union; the result is a new DataFrame
that a writer commits atomically (see ``monthend.sources.store``). All of
them are idempotent: applying the same update twice equals applying it once.

Fact schema: ``fecha date, metrica int, valor double``; key (fecha, metrica).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FACT_COLUMNS = ["fecha", "metrica", "valor"]


def as_fact(df: DataFrame) -> DataFrame:
    return df.select(F.col("fecha").cast("date").alias("fecha"),
                     F.col("metrica").cast("int").alias("metrica"),
                     F.col("valor").cast("double").alias("valor"))


def _month_keys(df: DataFrame) -> DataFrame:
    return df.select(F.year("fecha").alias("_y"), F.month("fecha").alias("_m"))


def delete_month_slices(target: DataFrame, months: DataFrame, ids: DataFrame) -> DataFrame:
    """B1: drop rows whose (year, month) is in ``months`` and id is in ``ids``.

    ``months`` (columns ``_y, _m``) is bounded by the calendar, so it is
    broadcast; rows of other months stream through without a shuffle. Only
    rows of the reloaded months meet ``ids`` (which may be large) in a join.
    An empty ``ids`` deletes nothing.
    """
    m = F.broadcast(months.select("_y", "_m").distinct())
    t = as_fact(target).withColumns({"_y": F.year("fecha"), "_m": F.month("fecha")})
    other_months = t.join(m, ["_y", "_m"], "left_anti")
    same_months = (t.join(m, ["_y", "_m"], "left_semi")
                   .join(ids.select("metrica").distinct(), "metrica", "left_anti"))
    return other_months.unionByName(same_months).select(*FACT_COLUMNS)


def replace_months(target: DataFrame, updates: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """B1+B2: reload whole month slices (the idempotent monthly load).

    For every month present in ``updates``, rows of ``target`` whose id is in
    ``ids`` (default: the ids present in ``updates``) are removed and
    ``updates`` are appended. Rows of those months with other ids (e.g. the
    media metrics during a web reload) are carried over untouched.
    """
    updates = as_fact(updates)
    ids = updates.select("metrica") if ids is None else ids
    kept = delete_month_slices(target, _month_keys(updates), ids)
    return kept.unionByName(updates)


def last_per_key(updates: DataFrame, keys: list[str], order_col: str | None = None) -> DataFrame:
    """Keep one update per key: the last by ``order_col``.

    Without an order column the largest value wins, which is deterministic
    (a batch upsert has no order of its own in a distributed frame).
    """
    if order_col is None:
        return updates.groupBy(*keys).agg(F.max("valor").alias("valor"))
    # max_by aggregates partially before the shuffle, so a key repeated a
    # million times is merged map-side instead of landing in one task
    # ties in the order go to the larger value, so the choice is deterministic
    return updates.groupBy(*keys).agg(
        F.max_by("valor", F.struct(order_col, "valor")).alias("valor"))


def upsert(target: DataFrame, updates: DataFrame, order_col: str | None = None) -> DataFrame:
    """Insert, or set ``valor`` when (fecha, metrica) exists.

    Only target rows of the months the updates touch meet the update keys in
    a join; the other months stream through against a broadcast month list
    (bounded by the calendar), so a small upsert does not shuffle the table.
    """
    keys = ["fecha", "metrica"]
    cols = FACT_COLUMNS + ([order_col] if order_col else [])
    u = as_fact(updates) if order_col is None else updates.select(*cols)
    u = as_fact(last_per_key(u, keys, order_col))
    m = F.broadcast(_month_keys(u).distinct())
    t = as_fact(target).withColumns({"_y": F.year("fecha"), "_m": F.month("fecha")})
    other_months = t.join(m, ["_y", "_m"], "left_anti")
    same_months = t.join(m, ["_y", "_m"], "left_semi").join(u.select(*keys), keys, "left_anti")
    return other_months.unionByName(same_months).select(*FACT_COLUMNS).unionByName(u)


def append_conflicts(target: DataFrame, updates: DataFrame) -> DataFrame:
    """The keys that keep a batch from being appended, each once.

    ``fecha, metrica``, ``copies`` (rows of the key in the batch), ``exists``
    (whether the table has it). The batch is counted first, so a key repeated
    a million times meets the table as one row; only target rows of the
    batch's months take part.
    """
    batch = as_fact(updates).groupBy("fecha", "metrica").agg(F.count(F.lit(1)).alias("copies"))
    months = F.broadcast(_month_keys(updates).distinct())
    t = as_fact(target).withColumns({"_y": F.year("fecha"), "_m": F.month("fecha")})
    there = (t.join(months, ["_y", "_m"], "left_semi").select("fecha", "metrica").distinct()
             .withColumn("exists", F.lit(True)))
    return (batch.join(there, ["fecha", "metrica"], "left")
            .select("fecha", "metrica", "copies", F.coalesce("exists", F.lit(False)).alias("exists"))
            .where(F.col("exists") | (F.col("copies") > 1)))


def insert_ignore(table: DataFrame, rows: DataFrame, key: str = "metrica") -> DataFrame:
    """Add rows whose key is absent; existing keys keep their row.

    When the batch itself repeats a key, one row is kept -- the smallest,
    so the result does not depend on how the batch is partitioned.
    """
    others = [c for c in table.columns if c != key]
    new = (rows.join(table.select(key), key, "left_anti")
           .groupBy(key).agg(F.min(F.struct(*others)).alias("_row"))
           .select(key, *[F.col(f"_row.{c}").alias(c) for c in others]))
    return table.unionByName(new.select(*table.columns))
