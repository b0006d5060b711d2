"""Every registered query against its SQL twin; without a twin it must give rows."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import TABLES, compare

NAMES = sorted(queries())


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


def test_twins_belong_to_queries():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert len(entry(spark).columns) == 24


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, sf, con, name):
    df = queries()[name](spark, sf)
    sql = oracle_sql().get(name)
    result = compare(df, con, sql) if sql else f"ok {df.count()}"
    assert result.startswith("ok"), result
    assert result != "ok 0"
