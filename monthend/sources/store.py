"""The fact table on shared storage, with month-slice mutations.

A versioned table (``monthend.sources.versions``) partitioned by ``year`` and
``month`` (from ``fecha``). A mutation reads the partitions of the months it
changes from the version it starts from, applies the DataFrame operator
(``replace_months`` / ``upsert``), writes the new slices to fresh folders and
commits all of them with one manifest. A job that fails, or is killed between
any two file operations, leaves the version it started from; a writer that
lost the race to another is refused (``CommitConflict``) and can be run
again, as every mutation is idempotent.

The reference deletes and inserts in two commits, and a crash between them
loses the month (T6); here the old slice stays until the new one is ready,
and several months become visible at once.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthend.operators import mutate as U
from monthend.session import materialize, scratch_path
from monthend.sources.versions import Version, VersionedTable, publish, published

PARTITIONS = ["year", "month"]
FACT_SCHEMA = "fecha date, metrica int, valor double"
Properties = dict | Callable[[], dict] | None


class DuplicateKeys(ValueError):
    """An append named keys that exist or repeat; ``path`` holds all of them."""

    def __init__(self, n: int, path: str):
        super().__init__(f"{n} keys exist already or are repeated; all in {path}")
        self.path = path


def month_key(year: int, month: int) -> str:
    return f"year={year}/month={month}"


def month_of(key: str) -> tuple[int, int]:
    """(year, month) of a partition; (0, 0) of one without a date."""
    year, month = (part.partition("=")[2] for part in key.split("/"))
    return (int(year), int(month)) if year.isdigit() and month.isdigit() else (0, 0)


class FactStore:
    """The newest version of the table, or with ``version`` the one of that number, to be read only."""

    def __init__(self, spark: SparkSession, root: str, version: int | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.table = VersionedTable(spark, self.root, FACT_SCHEMA, PARTITIONS)
        self.pinned = None if version is None else self.table.version(version)

    def version(self) -> Version:
        return self.pinned or self.table.version()

    def exists(self) -> bool:
        return bool(self.version().partitions)

    def read(self) -> DataFrame:
        """The whole fact table (fecha, metrica, valor)."""
        return U.as_fact(self.table.read(self.version()))

    def read_months(self, months: list[tuple[int, int]], version: Version | None = None) -> DataFrame:
        """Only the partitions of ``months`` [(year, month), ...]."""
        wanted = set(months)
        df = self.table.read(version or self.version(), lambda key: month_of(key) in wanted)
        ym = F.col("year") * 12 + F.col("month")      # partition columns only: pruned
        return U.as_fact(df.where(ym.isin(*sorted({y * 12 + m for y, m in months}))))

    def read_range(self, start: dt.date | None, end: dt.date | None) -> DataFrame:
        """Rows with ``start <= fecha < end`` (either bound optional).

        Only the month folders in range are named to Spark; the bounds are
        also written on the partition columns.
        """
        last = None if end is None else end - dt.timedelta(days=1)
        inside = lambda key: ((start is None or month_of(key) >= (start.year, start.month))
                              and (last is None or (0, 0) < month_of(key) <= (last.year, last.month)))
        df = self.table.read(self.version(), inside)
        ym = F.col("year") * 12 + F.col("month")
        if start is not None:
            df = df.where((ym >= start.year * 12 + start.month) & (F.col("fecha") >= F.lit(start)))
        if last is not None:
            df = df.where((ym <= last.year * 12 + last.month) & (F.col("fecha") < F.lit(end)))
        return U.as_fact(df)

    @staticmethod
    def _laid_out(df: DataFrame) -> DataFrame:
        """Range-partition on (year, month, metrica, ...) before writing.

        Files come out sorted by metric inside each month folder (tight
        Parquet statistics), and a month holding a large share of the rows is
        split over several tasks instead of landing in one.
        """
        parts = U.as_fact(df).withColumns({"year": F.year("fecha"), "month": F.month("fecha")})
        return parts.repartitionByRange(*PARTITIONS, "metrica", "fecha", "valor")

    def _commit(self, base: Version, slices: DataFrame, months: list[tuple[int, int]] | None,
                properties: dict | None = None) -> Version:
        """Commits ``slices`` as the whole content of ``months`` (None: of the table)."""
        if self.pinned:
            raise ValueError(f"{self.root}: a pinned version is read only")
        written = self.table.write_data(self._laid_out(slices))
        old = base.partitions if months is None else [month_key(*m) for m in months]
        return self.table.commit(base, {**dict.fromkeys(old), **written}, properties)

    def write_all(self, df: DataFrame, properties: dict | None = None) -> Version:
        """Initial load / full rewrite of the table."""
        return self._commit(self.version(), df, None, properties)

    @staticmethod
    def months_of(updates: DataFrame) -> list[tuple[int, int]]:
        """Distinct (year, month) of a batch: bounded by the calendar."""
        months = [(r[0], r[1]) for r in updates.select(F.year("fecha"), F.month("fecha")).distinct().collect()]
        if (None, None) in months:
            raise ValueError("a batch holds rows without a date")
        return months

    def replace_months(self, updates: DataFrame, ids: DataFrame | None = None, properties: Properties = None) -> Version:
        """B1+B2 on disk: reload the months present in ``updates``.

        ``properties`` are recorded with the commit; a function is called for
        them once the updates are computed (to store what was counted then).
        """
        return self._mutate(updates, lambda old, new: U.replace_months(old, new, ids), properties)

    def upsert(self, updates: DataFrame, order_col: str | None = None, properties: Properties = None) -> Version:
        """B3 on disk: insert or update (fecha, metrica) rows."""
        return self._mutate(updates, lambda old, new: U.upsert(old, new, order_col), properties)

    def _mutate(self, updates: DataFrame, change, properties: Properties) -> Version:
        base = self.version()
        updates = materialize(updates)      # read by several branches below
        properties = properties() if callable(properties) else properties
        months = self.months_of(updates)
        if not months:
            return self.table.commit(base, {}, properties) if properties else base
        return self._commit(base, change(self.read_months(months, base), updates), months, properties)

    def append(self, updates: DataFrame, properties: dict | None = None) -> Version:
        """B2 on its own: add rows, none of whose keys may exist or repeat.

        Only the months of the batch are read, and nothing of the table is
        rewritten: their partitions get one more folder. Where a key clashes
        nothing is appended, and ``DuplicateKeys`` names the stored list of
        all of them.
        """
        if self.pinned:
            raise ValueError(f"{self.root}: a pinned version is read only")
        base = self.version()
        updates = materialize(U.as_fact(updates))
        months = self.months_of(updates)
        if not months:
            return base
        path = scratch_path(self.spark, "append-conflicts")
        U.append_conflicts(self.read_months(months, base), updates).write.parquet(path)
        clashes = self.spark.read.parquet(path).count()
        if clashes:
            raise DuplicateKeys(clashes, path)
        written = self.table.write_data(self._laid_out(updates))
        return self.table.commit(base, {k: base.partitions.get(k, []) + v for k, v in written.items()}, properties)


__all__ = ["DuplicateKeys", "FactStore", "month_key", "month_of", "publish", "published"]
