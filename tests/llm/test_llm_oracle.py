"""Queries of the subpackage with oracle SQL equal DuckDB on sf0.001."""

import duckdb
import pytest

from conftest import SF001
from rivulet.llm.queries import ORACLE_SQL, QUERIES
from rivulet.sources.tables import TABLES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_oracle(spark, name):
    duck = duckdb.connect()
    for t in TABLES:
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    got = QUERIES[name](spark, SF001)
    want = duck.execute(ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(repr, map(tuple, got.select(*columns).collect()))) == sorted(map(repr, want.fetchall()))


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
