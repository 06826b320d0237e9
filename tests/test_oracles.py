"""Every registered query against DuckDB over the same files."""

import duckdb
import pytest

import __spark_entry__ as registered
from conftest import TESTDATA

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{TESTDATA}/{table}.parquet')")
    return connection


def plain(value):
    return round(value, 6) if isinstance(value, float) else value


def test_every_query_has_an_oracle():
    assert set(registered._builders()) == set(registered.oracle.statements())


@pytest.mark.parametrize("name", sorted(registered._builders()))
def test_query_equals_oracle(spark, duck, name):
    df = registered.queries()[name](spark, TESTDATA)
    expected = duck.execute(registered.oracle_sql()[name])
    types = {d[0]: str(d[1]) for d in expected.description}
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    columns = sorted(types)
    order = [list(types).index(c) for c in columns]
    wanted = sorted(repr([plain(row[i]) for i in order]) for row in expected.fetchall())
    found = sorted(repr([plain(v) for v in row]) for row in df.select(*columns).collect())
    assert found == wanted


def test_entry_runs(spark):
    df = registered.entry(spark)
    assert df.count() > 0 and df.columns == ["priority", "asset_id", "open_count", "oldest_planned_start", "computed_at"]
