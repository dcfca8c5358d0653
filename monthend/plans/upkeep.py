"""The comparison table kept current: only what a reload touched is computed again (Q1).

A ``ComparisonStore`` holds the comparison rows of a fact table, partitioned
by fiscal year, and in its commit the version of the fact table it stands
for. ``refresh`` takes it to the newest version:

1. The manifests of the two fact versions name the months whose folders
   differ. Only these are read, old and new, and compared by one fingerprint a
   metric and month; a month reloaded with equal rows touches nothing.
2. A touched month of a metric changes its own metric-year and the following
   one (prior-year values, the previous year's total). Where a metric has
   several rows a month, totals are weighted by the rows of the year before
   (T4), so the year after that changes too.
3. The comparison runs on these metric-years and the two before each, cut by
   month folders, by the range of touched ids (row groups are sorted by id)
   and by a join on metric and fiscal year.
4. The fiscal years' folders are written anew with the other metrics' rows as
   they were, and committed together with the fact version.

A glossary that gives other names touches all years of the names it changed;
the store keeps the names it was built with. A refresh that dies leaves the
old table, and the next one does the same work again. A comparison whose fact
version was vacuumed away is built whole.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthend.functions.calendar import FISCAL_START_MONTH, fiscal_year
from monthend.operators.compare import REPORT_COLUMNS, compare_table, duplicate_months
from monthend.operators.lookup import ids_to_names
from monthend.session import materialize
from monthend.sources.store import FactStore, month_of
from monthend.sources.versions import Version, VersionedTable, changed_partitions

SCHEMA = ("Date date, Metric string, Value double, ytd double, year_over_year double, "
          "ytd_over_year double, Previous_FY_Value double")
YEAR = "fiscal_year"
PAIR = ["Metric", YEAR]
BEFORE = 2  # fiscal years before a computed one that its rows depend on


def _with_year(df: DataFrame) -> DataFrame:
    return df.withColumn(YEAR, fiscal_year("Date"))


def _following(pairs: DataFrame, first: int, last: int) -> DataFrame:
    """Each metric-year with those ``first`` to ``last`` years after it."""
    years = F.sequence(F.col(YEAR) + first, F.col(YEAR) + last)
    return pairs.select("Metric", F.explode(years).alias(YEAR)).distinct()


def changed_metric_months(old: DataFrame, new: DataFrame) -> DataFrame:
    """``metrica, month, rows`` of the metrics' months whose rows differ between two fact frames.

    Rows are compared as a multiset, by count and two sums of hashes; ``rows``
    is the larger of the two counts.
    """
    def prints(df: DataFrame, side: str) -> DataFrame:
        row = [F.date_format("fecha", "yyyy-MM-dd"), F.col("valor")]
        total = lambda seed: F.sum(F.xxhash64(F.lit(seed), *row, F.col("valor").isNull()).cast("decimal(38,0)"))
        return df.groupBy("metrica", F.trunc("fecha", "month").alias("month")).agg(
            F.struct(F.count(F.lit(1)).alias("n"), total(1).alias("h1"), total(2).alias("h2")).alias(side))

    both = prints(old, "was").join(prints(new, "now"), ["metrica", "month"], "full")
    rows = F.greatest(F.coalesce("was.n", F.lit(0)), F.coalesce("now.n", F.lit(0)))
    return both.where(~F.col("was").eqNullSafe(F.col("now"))).select("metrica", "month", rows.alias("rows"))


class ComparisonStore:
    """Comparison rows on disk (``read``) and the names they were built with (``names``)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.table = VersionedTable(spark, f"{self.root}/rows", SCHEMA, [YEAR])

    def read(self) -> DataFrame:
        return self.table.read().select(*REPORT_COLUMNS)

    def names(self, version: Version) -> DataFrame:
        path = version.properties.get("names")
        return self.spark.read.parquet(path) if path else self.spark.createDataFrame([], "metrica int, nombre string")

    def refresh(self, facts: FactStore, glossary: DataFrame) -> dict:
        """Takes the table to the newest fact version; what was done (``months``, ``pairs``, ``years``, ``path``)."""
        base, source = self.table.version(), facts.version()
        facts = FactStore(self.spark, facts.root, source.number)     # one version throughout
        names = materialize(glossary.select(F.col("metrica").cast("int").alias("metrica"), "nombre").distinct())
        known = self.names(base)
        last = base.properties.get("fact_version", 0)
        whole = base.number == 0 or (last != source.number and last not in facts.table.numbers())
        was = Version(0) if whole else facts.table.version(last)
        keys = changed_partitions(was, source)
        months = [month_of(k) for k in keys]
        changed = materialize(changed_metric_months(facts.read_months(months, was), facts.read_months(months, source)))
        renamed = materialize(names.join(known, ["metrica", "nombre"], "left_anti").unionByName(
            known.join(names, ["metrica", "nombre"], "left_anti"))) if not whole else names.limit(0)
        touched = self._touched(facts, changed, names, known, renamed)
        done = {"months": len(months), "pairs": touched.count(), "years": [], "path": None}
        properties = {"fact_version": source.number, "names": self._stored_names(base, names, renamed, whole)}
        if done["pairs"] or whole and base.partitions:
            slices, done["path"] = self._computed(facts, touched, changed, names)
            after = BEFORE if done["path"] == "join" else 1
            slices, pairs = materialize(slices), _following(touched, 0, after)
            years = {r[0] + i for r in touched.select(YEAR).distinct().collect() for i in range(after + 1)}
            folders = list(base.partitions) if whole else [f"{YEAR}={y}" for y in years]
            done["years"] = sorted(years)
            if not whole:
                slices = self.table.read(base, lambda key: key in folders).join(pairs, PAIR, "left_anti").unionByName(slices)
            written = self.table.write_data(slices.repartitionByRange(YEAR, "Metric", "Date"))
            self.table.commit(base, {**dict.fromkeys(folders), **written}, properties)
        elif properties != {k: base.properties.get(k) for k in properties}:
            self.table.commit(base, {}, properties)
        return done

    def _stored_names(self, base: Version, names: DataFrame, renamed: DataFrame, whole: bool) -> str:
        if not whole and "names" in base.properties and renamed.isEmpty():
            return base.properties["names"]
        path = f"{self.root}/names/{base.number + 1:012d}"
        names.write.mode("overwrite").parquet(path)
        return path

    def _touched(self, facts: FactStore, changed: DataFrame, names: DataFrame, known: DataFrame,
                 renamed: DataFrame) -> DataFrame:
        """The metric-years (``Metric, fiscal_year``) with rows that came, went or changed."""
        either = names.unionByName(known).distinct()
        pairs = changed.join(either, "metrica").select(
            F.col("nombre").alias("Metric"), fiscal_year("month").alias(YEAR))
        if not renamed.isEmpty():
            ids = renamed.select("metrica").distinct()
            all_years = facts.read().join(ids, "metrica", "left_semi").select(
                "metrica", fiscal_year("fecha").alias(YEAR)).distinct()
            pairs = pairs.unionByName(all_years.join(renamed, "metrica").select(F.col("nombre").alias("Metric"), YEAR))
        return materialize(pairs.where(F.col("Metric").isNotNull()).distinct())

    def _computed(self, facts: FactStore, touched: DataFrame, changed: DataFrame, names: DataFrame) -> tuple[DataFrame, str]:
        """The new rows of the touched metric-years and of those after them, with their fiscal year."""
        needed = _following(touched, -BEFORE, BEFORE)
        first, last = touched.agg(F.min(YEAR), F.max(YEAR)).first()
        ids = materialize(names.join(touched.select(F.col("Metric").alias("nombre")).distinct(), "nombre", "left_semi"))
        low, high = ids.agg(F.min("metrica"), F.max("metrica")).first()
        if low is None:     # none of the touched names is left
            return self.spark.createDataFrame([], f"{SCHEMA}, {YEAR} int"), "join"
        start = dt.date(first - BEFORE, FISCAL_START_MONTH, 1)
        rows = facts.read_range(start, dt.date(last + BEFORE + 1, FISCAL_START_MONTH, 1))
        rows = rows.where(F.col("metrica").between(low, high))
        named = materialize(_with_year(ids_to_names(rows.join(ids.select("metrica").distinct(), "metrica", "left_semi"), ids))
                            .join(needed, PAIR, "left_semi"))
        shared = ids.groupBy("nombre").count().where("count > 1")      # a name of several ids
        several = not (changed.where("rows > 1").isEmpty() and duplicate_months(named).isEmpty() and shared.isEmpty())
        path = "join" if several else "window"
        computed = _with_year(compare_table(named.drop(YEAR), path=path))
        return computed.join(_following(touched, 0, BEFORE if several else 1), PAIR, "left_semi"), path
