"""As-of joins and overlap checks for effective-dated tables of any size.

Both sides are put in one order -- key, time, source rows before the rows that
ask -- and each asking row takes the last source row before it. That is a
running maximum (``running.prefix_max``), so neither side is joined with
itself, no row meets more than one other, and a key that holds a third of all
rows is spread over ranges instead of being one task's.

Overlaps are found by the same sweep: a row clashes with an earlier one if it
begins before the largest end so far.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from monthend.operators.running import prefix_max

SMALL = 10_000  # rows of a source table that one task may sort


def as_of(left: DataFrame, right: DataFrame, by: list[str], at: str, since: str, take: list[str]) -> DataFrame:
    """The columns of ``left`` and, of the last row of ``right`` with the same ``by`` and ``since <= at``, ``since`` and ``take``.

    They are null where there is no such row, or where a key or time is null.
    Of several source rows with one key and time the largest by ``take``
    counts. Names must not clash, but for ``by``.
    """
    known = " and ".join(f"`{c}` is not null" for c in by)
    source = (right.where(f"{known} and `{since}` is not null").groupBy(*by, F.col(since).alias("_t"))
              .agg(F.max(F.struct(F.col(since), *take)).alias("_source")))
    whole = F.struct(*[F.col(f"`{c}`") for c in left.columns])
    asking = left.select(*by, F.col(at).alias("_t"), whole.alias("_row"))
    able = f"{known} and _t is not null"
    rows = (source.withColumns({"_asks": F.lit(0), "_row": F.lit(None).cast(asking.schema["_row"].dataType)})
            .unionByName(asking.where(able).withColumns(
                {"_asks": F.lit(1), "_source": F.lit(None).cast(source.schema["_source"].dataType)}))
            .withColumn("_tie", F.when(F.col("_asks") == 1, F.monotonically_increasing_id()).otherwise(F.lit(-1))))
    found = prefix_max(rows, by, ["_t", "_asks", "_tie"], {"_last": F.col("_source")}).where("_asks = 1").select("_row", "_last")
    none = asking.where(f"not ({able})").select("_row", F.lit(None).cast(source.schema["_source"].dataType).alias("_last"))
    return found.unionByName(none).select("_row.*", *[F.col(f"_last.{c}").alias(c) for c in [since, *take]])


def overlaps(table: DataFrame, by: list[str], start: str, end: str, name: str, scope: str | None = None) -> DataFrame:
    """``name, other`` of rows whose interval ``[start, end)`` begins inside an earlier one of the same ``by``.

    With ``scope`` rows clash only if their scopes are equal or one of them is
    null (it then stands for all). Intervals that are empty or have a null
    bound hold nothing and clash with nothing. A clashing row is told with the
    row of the largest end before it, not with every row it meets.
    """
    known = " and ".join(f"`{c}` is not null" for c in by)
    rows = table.where(f"{known} and `{start}` < `{end}`").select(
        *by, F.col(start).alias("_from"), F.col(end).alias("_to"), F.col(name).alias("_name"),
        (F.lit(None).cast("string") if scope is None else F.col(scope).cast("string")).alias("_scope"),
        F.monotonically_increasing_id().alias("_tie"))
    rows = rows.withColumn("_for_all", F.col("_scope").isNull())
    until = F.struct("_to", "_name")
    in_one_task = table.limit(SMALL + 1).count() <= SMALL

    def before(df: DataFrame, group: list[str], values: dict) -> DataFrame:
        order = ["_from", "_to", "_name", "_tie"]
        if not in_one_task:
            return prefix_max(df, group, order, values)
        earlier = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumns({k: F.max(v).over(earlier) for k, v in values.items()})

    swept = before(rows, by, {"_any": until, "_all": F.when(F.col("_for_all"), until)})
    hits = swept.withColumn("_hit", F.when(F.col("_for_all"), F.col("_any")).otherwise(F.col("_all")))
    if scope is not None:
        own = before(rows.where("not _for_all"), [*by, "_scope"], {"_hit": until})
        hits = hits.select("_from", "_name", "_hit").unionByName(own.select("_from", "_name", "_hit"))
    return hits.where("_hit._to > _from").select(F.col("_name").alias("name"), F.col("_hit._name").alias("other")).distinct()
