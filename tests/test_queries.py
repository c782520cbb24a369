"""Every registered query against its SQL counterpart in DuckDB."""

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as registry

SF_DIR = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = registry.lake_queries(), registry.lake_sql()

pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="test tables are not there")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _comparable(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    expected = duck.execute(ORACLES[name])
    columns = [c[0] for c in expected.description]
    assert sorted(df.columns) == sorted(columns)
    ours = _comparable(df.columns, [tuple(row) for row in df.collect()])
    theirs = _comparable(columns, expected.fetchall())
    assert len(ours) == len(theirs)
    assert ours == theirs


def test_entry(spark):
    assert registry.entry(spark).count() > 0
