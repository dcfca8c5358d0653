"""The comparison kept current equals the comparison computed whole, after any sequence of reloads."""

import datetime as dt
import random

import pytest

from monthend.operators.compare import REPORT_COLUMNS, compare_table
from monthend.operators.lookup import ids_to_names
from monthend.plans.upkeep import ComparisonStore
from monthend.sources.store import FactStore, month_of

D = dt.date
FACT = "fecha date, metrica int, valor double"
NAMES = "metrica int, nombre string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def month_end(y, m):
    return D(y + m // 12, m % 12 + 1, 1) - dt.timedelta(days=1)


def history(rng, ids, years, copies=1):
    return [(month_end(y, m), i, rng.choice([None, float(rng.randrange(100)) / 4]))
            for y in years for m in range(1, 13) for i in ids for _ in range(rng.randint(1, copies)) if rng.random() < 0.9]


def whole(spark, facts, glossary):
    return rows(compare_table(ids_to_names(facts.read(), glossary)).select(*REPORT_COLUMNS))


@pytest.mark.parametrize("copies", [1, 2])
def test_after_any_sequence_of_reloads(spark, tmp_path, copies):
    rng = random.Random(copies)
    facts, kept = FactStore(spark, str(tmp_path / "fact")), ComparisonStore(spark, str(tmp_path / "compare"))
    facts.write_all(spark.createDataFrame(history(rng, [1, 2, 3, 4], range(2021, 2025), copies), FACT))
    names = [(1, "A Views"), (2, "A Views Per Session"), (3, "B"), (4, None), (5, "C Per Session"), (9, "nobody")]
    glossary = spark.createDataFrame(names, NAMES)
    assert kept.refresh(facts, glossary)["pairs"] > 10
    assert rows(kept.read()) == whole(spark, facts, glossary)
    for step in range(2):
        for _ in range(rng.choice([1, 2])):
            y, ids = rng.randrange(2020, 2026), rng.sample([1, 2, 3, 4, 5], rng.choice([1, 2]))
            months = {rng.randrange(1, 13) for _ in range(2)}
            batch = [r for r in history(rng, ids, [y], copies) if r[0].month in months] or [(month_end(y, 1), 1, 0.5)]
            change = spark.createDataFrame(batch, FACT)
            facts.upsert(change) if rng.random() < 0.3 else facts.replace_months(change)
        done = kept.refresh(facts, glossary)
        assert done["path"] in ({"join"} if copies > 1 else {"window"}) or not done["pairs"]
        assert rows(kept.read()) == whole(spark, facts, glossary), step
    facts.write_all(facts.read().where("metrica <> 3 and fecha < date'2023-01-01'"))      # rows that go away
    kept.refresh(facts, glossary)
    assert rows(kept.read()) == whole(spark, facts, glossary)


def test_only_touched_metric_years_are_read(spark, tmp_path, monkeypatch):
    rng = random.Random(3)
    facts, kept = FactStore(spark, str(tmp_path / "fact")), ComparisonStore(spark, str(tmp_path / "compare"))
    ids = range(1, 21)
    facts.write_all(spark.createDataFrame([(month_end(y, m), i, float(rng.randrange(9)))
                                           for y in range(2010, 2025) for m in range(1, 13) for i in ids], FACT))
    glossary = spark.createDataFrame([(i, f"m{i}") for i in ids], NAMES)
    kept.refresh(facts, glossary)
    facts.upsert(spark.createDataFrame([(D(2016, 3, 31), 7, 1000.0), (D(2016, 4, 30), 8, None)], FACT))
    opened, plain = set(), type(facts.table).read

    def read(self, version=None, keep=lambda key: True):
        if self.schema.startswith("fecha"):
            opened.update(k for k in (version or self.version()).partitions if keep(k))
        return plain(self, version, keep)

    monkeypatch.setattr(type(facts.table), "read", read)
    done = kept.refresh(facts, glossary)
    assert done == {"months": 2, "pairs": 2, "years": [2015, 2016], "path": "window"}
    fiscal = {y - (m < 8) for y, m in map(month_of, opened)}
    assert fiscal == {2013, 2014, 2015, 2016, 2017}      # of fifteen
    monkeypatch.undo()
    assert rows(kept.read()) == whole(spark, facts, glossary)
    before = kept.table.version()
    assert kept.refresh(facts, glossary)["pairs"] == 0 and kept.table.version() == before
    facts.upsert(spark.createDataFrame([(D(2016, 3, 31), 7, 1000.0)], FACT))     # the same value again
    assert kept.refresh(facts, glossary) == {"months": 1, "pairs": 0, "years": [], "path": None}
    assert kept.table.version().properties["fact_version"] == facts.version().number


def test_names_that_change_and_versions_that_are_gone(spark, tmp_path):
    rng = random.Random(4)
    facts, kept = FactStore(spark, str(tmp_path / "fact")), ComparisonStore(spark, str(tmp_path / "compare"))
    facts.write_all(spark.createDataFrame(history(rng, [1, 2, 3], range(2020, 2024)), FACT))
    kept.refresh(facts, spark.createDataFrame([(1, "A"), (2, "B")], NAMES))
    for names in ([(1, "A"), (2, "B Per Session"), (3, "C")], [(1, "A"), (2, "A"), (3, "C")], [(1, "A"), (3, "C")], [(9, "z")]):
        glossary = spark.createDataFrame(names, NAMES)
        kept.refresh(facts, glossary)
        assert rows(kept.read()) == whole(spark, facts, glossary), names
    glossary = spark.createDataFrame([(1, "A"), (2, "B")], NAMES)
    for value in range(3):
        facts.upsert(spark.createDataFrame([(D(2021, 1, 31), 1, float(value))], FACT))
    facts.table.vacuum(keep=1, grace_hours=-1.0)
    kept.refresh(facts, glossary)
    assert rows(kept.read()) == whole(spark, facts, glossary)


def test_a_refresh_that_dies_is_done_again(spark, tmp_path, monkeypatch):
    rng = random.Random(5)
    facts, kept = FactStore(spark, str(tmp_path / "fact")), ComparisonStore(spark, str(tmp_path / "compare"))
    facts.write_all(spark.createDataFrame(history(rng, [1, 2], range(2020, 2024)), FACT))
    glossary = spark.createDataFrame([(1, "A"), (2, "B")], NAMES)
    kept.refresh(facts, glossary)
    old = rows(kept.read())
    facts.upsert(spark.createDataFrame([(D(2021, 1, 31), 1, 77.0)], FACT))
    with monkeypatch.context() as patch:
        patch.setattr(type(kept.table), "commit", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError, match="killed"):
            kept.refresh(facts, glossary)
    assert rows(kept.read()) == old
    kept.refresh(facts, glossary)
    assert rows(kept.read()) == whole(spark, facts, glossary)
