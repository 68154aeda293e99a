"""Every registered query against its SQL counterpart on the smallest data set."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = Path("/root/testdata/sf0.001")
QUERIES, SQL = contract.queries(), contract.oracle_sql()

pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="no test data")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in SF_DIR.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def comparable(rows):
    def plain(value):
        return "nan" if isinstance(value, float) and math.isnan(value) else value

    cleaned = [tuple(plain(v) for v in row) for row in rows]
    return sorted(cleaned, key=lambda row: [(v is None, str(v)) for v in row])


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, database, name):
    result = QUERIES[name](spark, str(SF_DIR))
    columns = sorted(result.columns)
    got = comparable([tuple(row[c] for c in columns) for row in result.collect()])
    if name not in SQL:
        assert got
        return
    cursor = database.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    expected = [dict(zip(names, row)) for row in cursor.fetchall()]
    assert got == comparable([tuple(row[c] for c in columns) for row in expected])


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(QUERIES)
