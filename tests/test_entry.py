"""Driver contract and every SQL oracle at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as entry
from acctlens.plans.oracle import SQL
from tools.oracle_check import rows
from tests.conftest import SF_SMALL

TABLES = ["events"]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "ratioSum" in df.columns


def test_oracle_keys_are_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    spd = entry.queries()[name](spark, SF_SMALL).toPandas()
    dpd = con.execute(entry.oracle_sql()[name]).df()
    assert sorted(spd.columns) == sorted(dpd.columns)
    assert len(spd) == len(dpd)
    assert rows(spd) == rows(dpd)
