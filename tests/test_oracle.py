"""Every query with oracle SQL equals DuckDB on the sf0.001 tables
(row count, column names, exact values)."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF001
from rivulet.plans.catalog import entries
from rivulet.sources.tables import TABLES
from tools.oracle_check import digest


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(n for n, e in entries().items() if e.sql))
def test_query_equals_oracle(spark, duck, name):
    got = E.queries()[name](spark, SF001).toPandas()
    want = duck.execute(E.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert digest(got) == digest(want)
