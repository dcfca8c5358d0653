"""The driver contract: entry() and every registered query against its SQL oracle."""

import os
import subprocess
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import TABLES, rows_key  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["Date", "Metric", "Value", "ytd", "year_over_year",
                          "ytd_over_year", "Previous_FY_Value"]
    assert df.count() == 15


def test_entry_stands_without_the_optional_package():
    """The metrics queries are there when the training-data operators, or what they import, are not."""
    hide = ("import sys; sys.modules[{!r}] = None; import __spark_entry__ as E; "
            "assert not E.EXTRA_QUERIES and len(E.queries()) == {}, len(E.queries())")
    for missing in ("monthend.llm", "public_tokenizers"):
        subprocess.run([sys.executable, "-c", hide.format(missing, len(OWN))], check=True,
                       cwd=os.path.dirname(E.__file__))


OWN = sorted(set(E.queries()) - set(E.EXTRA_QUERIES))


def test_every_query_has_an_oracle():
    assert set(OWN) == set(E.oracle_sql()) - set(E.EXTRA_ORACLES)


@pytest.mark.parametrize("name", OWN)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    orows = cur.fetchall()
    order = [ocols.index(c) for c in df.columns]
    assert rows_key(tuple(r) for r in df.collect()) == rows_key(tuple(r[i] for i in order) for r in orows)
