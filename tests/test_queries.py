"""Every registered query against its SQL statement on DuckDB."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_point

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9) + 0.0
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(entry_point.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    frame = entry_point.queries()[name](spark, FOLDER)
    result = duck.sql(entry_point.oracle_sql()[name])
    assert sorted(frame.columns) == sorted(result.columns)
    got = _rows(frame.columns, [tuple(r) for r in frame.collect()])
    want = _rows(result.columns, result.fetchall())
    assert len(got) == len(want)
    assert got == want


def test_entry_returns_rows(spark):
    assert entry_point.entry(spark).count() > 0
