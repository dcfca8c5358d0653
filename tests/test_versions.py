"""Versioned tables: commits that die anywhere, lost races, pinned readers, appends."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from monthend.sources import versions as V
from monthend.sources.store import DuplicateKeys, FactStore

D = dt.date
FACT = "fecha date, metrica int, valor double"


class Killed(Exception):
    pass


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def fact(spark, *values):
    return spark.createDataFrame(list(values), FACT)


@pytest.fixture
def base(spark):
    return fact(spark, (D(2023, 12, 31), 1, 3.0), (D(2024, 1, 31), 1, 1.0), (D(2024, 1, 31), 13, 5.0), (D(2024, 2, 29), 1, 2.0))


def operations(monkeypatch, die_at):
    """Counts the file operations of commits; the one of this number is never done, or done just before the end."""
    done = []

    def counted(cls, name):
        plain = getattr(cls, name)

        def wrapper(*args, **kw):
            done.append(name)
            if die_at == (len(done), "before"):
                raise Killed
            out = plain(*args, **kw)
            if die_at == (len(done), "after"):
                raise Killed
            return out
        monkeypatch.setattr(cls, name, wrapper)

    for cls, name in ((V.VersionedTable, "write_data"), (V.Files, "write"), (V.Files, "rename_new")):
        counted(cls, name)
    return done


@pytest.mark.parametrize("die_at", [(n, when) for n in (1, 2, 3) for when in ("before", "after")])
def test_a_kill_between_any_two_operations_leaves_a_whole_table(spark, tmp_path, monkeypatch, base, die_at):
    """Two months at once are old or new together, and the job run again ends at the new table."""
    store = FactStore(spark, str(tmp_path / "fact"))
    store.write_all(base)
    updates = fact(spark, (D(2024, 1, 31), 1, 10.0), (D(2024, 2, 29), 1, 20.0))
    new = [(D(2023, 12, 31), 1, 3.0), (D(2024, 1, 31), 1, 10.0), (D(2024, 1, 31), 13, 5.0), (D(2024, 2, 29), 1, 20.0)]
    with monkeypatch.context() as patch:
        done = operations(patch, die_at)
        with pytest.raises(Killed):
            store.replace_months(updates)
        assert done == ["write_data", "write", "rename_new"][:die_at[0]]
    reader = FactStore(spark, store.root)
    assert rows(reader.read()) == (new if die_at == (3, "after") else rows(base))
    reader.replace_months(updates)
    assert rows(reader.read()) == new


def test_a_failed_job_leaves_the_version(spark, tmp_path, base):
    store = FactStore(spark, str(tmp_path / "fact"))
    store.write_all(base)
    bad = base.withColumn("valor", F.when(F.col("metrica") == 13, F.raise_error(F.lit("lost")).cast("double")).otherwise(F.lit(0.0)))
    with pytest.raises(Exception, match="lost"):
        store.replace_months(bad)
    assert store.version().number == 1 and rows(store.read()) == rows(base)


def test_the_second_of_two_writers_is_refused(spark, tmp_path, base):
    store = FactStore(spark, str(tmp_path / "fact"))
    start = store.write_all(base)
    first = store.table.write_data(store._laid_out(fact(spark, (D(2024, 1, 31), 1, 7.0))))
    second = store.table.write_data(store._laid_out(fact(spark, (D(2024, 1, 31), 1, 8.0))))
    store.table.commit(start, first)
    with pytest.raises(V.CommitConflict):
        store.table.commit(start, second)
    assert rows(store.read_months([(2024, 1)])) == [(D(2024, 1, 31), 1, 7.0)]
    assert store.version().number == 2
    assert not [n for n in os.listdir(tmp_path / "fact" / "_versions") if n.startswith(".") and not n.endswith(".crc")]


def test_pinned_readers_keep_their_version(spark, tmp_path, base):
    store = FactStore(spark, str(tmp_path / "fact"))
    number = store.write_all(base).number
    before = store.read()       # planned against version 1
    store.upsert(fact(spark, (D(2024, 1, 31), 13, 6.0)))
    pinned = FactStore(spark, store.root, version=number)
    assert rows(pinned.read()) == rows(before) == rows(base)
    assert rows(pinned.read_range(D(2024, 1, 1), D(2024, 2, 1))) == [(D(2024, 1, 31), 1, 1.0), (D(2024, 1, 31), 13, 5.0)]
    with pytest.raises(ValueError, match="read only"):
        pinned.upsert(base)
    assert V.changed_partitions(store.table.version(1), store.version()) == ["year=2024/month=1"]


def test_vacuum_keeps_what_kept_versions_and_writers_use(spark, tmp_path, base):
    store = FactStore(spark, str(tmp_path / "fact"))
    store.write_all(base)
    for value in (1.0, 2.0, 3.0):
        store.upsert(fact(spark, (D(2024, 2, 29), 1, value)))
    other = store.table.write_data(store._laid_out(base))     # a writer that has not committed yet
    assert store.table.vacuum(keep=2) == []                   # all are younger than the grace time
    gone = store.table.vacuum(keep=2, grace_hours=-1.0)
    assert {f.rsplit("/year=", 1)[0] for fs in other.values() for f in fs} <= set(gone)
    assert len(gone) == 2 and store.table.numbers() == [3, 4]
    assert rows(FactStore(spark, store.root, version=3).read())[-1] == (D(2024, 2, 29), 1, 2.0)
    assert rows(store.read())[-1] == (D(2024, 2, 29), 1, 3.0)


def test_a_folder_without_versions_is_taken_over(spark, tmp_path, base):
    root = str(tmp_path / "fact")
    parts = base.withColumns({"year": F.year("fecha"), "month": F.month("fecha")})
    parts.write.partitionBy("year", "month").parquet(root)
    store = FactStore(spark, root)
    assert rows(store.read()) == rows(base)
    store.upsert(fact(spark, (D(2024, 2, 29), 1, 9.0), (D(2025, 1, 31), 2, 4.0)))
    assert rows(store.read()) == sorted([*rows(base)[:3], (D(2024, 2, 29), 1, 9.0), (D(2025, 1, 31), 2, 4.0)])


def test_append_refuses_keys_that_exist_or_repeat(spark, tmp_path, base):
    store = FactStore(spark, str(tmp_path / "fact"))
    store.write_all(base)
    with pytest.raises(DuplicateKeys) as e:
        store.append(fact(spark, (D(2024, 1, 31), 1, 0.0), (D(2024, 3, 31), 1, 0.0), (D(2024, 3, 31), 1, 0.0), (D(2024, 3, 31), 2, 0.0)))
    assert rows(spark.read.parquet(e.value.path)) == [(D(2024, 1, 31), 1, 1, True), (D(2024, 3, 31), 1, 2, False)]
    assert store.version().number == 1 and rows(store.read()) == rows(base)
    kept = store.version().partitions["year=2024/month=1"]
    store.append(fact(spark, (D(2024, 1, 31), 2, 0.5), (D(2024, 3, 31), 2, 0.0)))
    assert rows(store.read()) == sorted([*rows(base), (D(2024, 1, 31), 2, 0.5), (D(2024, 3, 31), 2, 0.0)])
    assert store.version().partitions["year=2024/month=1"][:1] == kept
    store.append(fact(spark))
    assert store.version().number == 2


def test_rows_without_a_date_are_refused(spark, tmp_path, base):
    store = FactStore(spark, str(tmp_path / "fact"))
    store.write_all(base)
    with pytest.raises(ValueError, match="without a date"):
        store.upsert(fact(spark, (None, 1, 1.0)))
    assert rows(store.read()) == rows(base)


def test_published_folders(spark, tmp_path):
    path = str(tmp_path / "tab")
    write = lambda value: lambda folder: spark.range(value).write.parquet(folder)
    V.publish(spark, path, write(3))
    first = V.published(spark, path)
    with pytest.raises(Killed):
        V.publish(spark, path, lambda folder: (_ for _ in ()).throw(Killed))
    assert V.published(spark, path) == first and spark.read.parquet(first).count() == 3
    V.publish(spark, path, write(4))
    assert spark.read.parquet(V.published(spark, path)).count() == 4
    assert spark.read.parquet(first).count() == 3     # a reader of the old content still finds it
    plain = str(tmp_path / "plain")
    spark.range(2).write.parquet(plain)
    assert V.published(spark, plain) == plain
