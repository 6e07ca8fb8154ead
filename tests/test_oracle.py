"""Every named query against the SQL text, run by an independent engine."""

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_points

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "orders",
    "lineitem",
    "documents",
    "embeddings",
)
SQL = entry_points.oracle_sql()
QUERIES = entry_points.queries()


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'"
        )
    return connection


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(value):
        return round(value, 6) + 0.0 if isinstance(value, float) else value

    return Counter(tuple(plain(row[i]) for i in order) for row in values)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees(spark, engine, name):
    frame = QUERIES[name](spark, FOLDER)
    result = engine.execute(SQL[name])
    columns = [column[0] for column in result.description]
    assert sorted(frame.columns) == sorted(columns)
    got, expected = rows(frame.columns, frame.collect()), rows(columns, result.fetchall())
    assert sum(got.values()) == sum(expected.values())
    assert got - expected == Counter()
    if "0.001" not in FOLDER:  # the smallest tables miss some of the planted faults
        assert got, "a query without rows proves nothing"


def test_every_statement_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry_points.entry(spark).count() == 20
