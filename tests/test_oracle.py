"""Every registered query against its DuckDB oracle on the sf0.001 driver tables
(the driver repeats this at sf0.01)."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from scripts.check_oracle import TABLES, rows_of
from tidewater.plans.queries import REGISTRY

SF = os.environ.get("TIDEWATER_TEST_SF", "/root/testdata/sf0.001")
NAMES = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert not set(REGISTRY) - set(E.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[:2] == ["stt", "edt"]
    assert df.count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert got == rows_of(cols, cur.fetchall())
