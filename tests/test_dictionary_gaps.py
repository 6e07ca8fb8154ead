"""Columns the dictionary lacks are reported with their fill, in every layer."""

import datetime as dt
from collections import Counter

import duckdb
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from tripfold.operators import contracts
from tripfold.queries import Feed, dictionary_gaps
from tripfold.sources.orders_feed import SCHEMAS

GAPS = ("l_returnflag", "l_linestatus", "o_orderstatus", "c_mktsegment")


def write_tables(spark, folder, items):
    """Two orders of one customer; items are (order, return flag, line status)."""
    day = dt.datetime(1995, 1, 5)
    tables = {
        "region": [(0, "EAST")],
        "nation": [(0, "ONE", 0), (1, "TWO", 0)],
        "customer": [(1, "c", 0, 1.0, None)],
        "supplier": [(1, "s", 1, 1.0)],
        "orders": [(1, 1, "O", 9.0, day, "1"), (2, 1, None, 9.0, day, "1")],
        "lineitem": [
            (order, 7, 1, 2, 4.0, 1000.0, 0.0, 0.0, flag, status, day)
            for order, flag, status in items
        ],
    }
    for name, rows in tables.items():
        spark.createDataFrame(rows, SCHEMAS[name]).write.parquet(f"{folder}/{name}.parquet")


def queried(spark, folder):
    frame = entry_points.queries()["dictionary_gaps"](spark, folder)
    columns = ["table_name", "column_name", "data_type", "populated"]
    assert sorted(frame.columns) == sorted(columns)
    return Counter(tuple(row) for row in frame.select(*columns).collect())


def by_sql(folder):
    engine = duckdb.connect()
    for name in SCHEMAS:
        engine.execute(
            f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet/*.parquet'"
        )
    return Counter(
        engine.sql(entry_points.oracle_sql()["dictionary_gaps"])
        .select("table_name, column_name, data_type, populated")
        .fetchall()
    )


def test_query_counts_the_filled_rows_of_gaps(spark, tmp_path):
    items = [(1, "A", None), (1, None, None), (2, "N", "F"), (2, "R", None), (2, "R", None)]
    write_tables(spark, tmp_path, items)
    fills = dict(zip(GAPS, (4, 1, 2, 0), strict=True))
    expected = Counter(("bronze.yellow_trips", c, "string", n) for c, n in fills.items())
    assert queried(spark, str(tmp_path)) == expected
    assert by_sql(tmp_path) == expected


def test_query_names_gaps_of_tables_without_rows(spark, tmp_path):
    write_tables(spark, tmp_path, [])
    expected = Counter(("bronze.yellow_trips", c, "string", 0) for c in GAPS)
    assert queried(spark, str(tmp_path)) == expected
    assert by_sql(tmp_path) == expected


def test_query_looks_at_every_layer(spark, tmp_path):
    write_tables(spark, tmp_path, [(1, "A", "F"), (2, None, "F")])
    feed = Feed(spark, str(tmp_path))
    feed.pickup_mart = feed.pickup_mart.withColumn("surprise", F.lit(1))
    found = {(r.table_name, r.column_name) for r in dictionary_gaps(feed).collect()}
    assert ("gold.mart_pickup_activity", "surprise") in found


def test_operator_counts_gaps_of_several_tables(spark):
    frames = {
        "a": spark.createDataFrame(
            [("1", 2), (None, None), ("3", None)], "zone string, `x.y` int"
        ),
        "b": spark.createDataFrame([(None,)], "odd double"),
        "c": spark.createDataFrame([("2026-01",)], "source_month string"),
    }
    gaps = contracts.dictionary_gaps(frames, with_populated=True)
    assert sorted(tuple(r) for r in gaps.collect()) == [
        ("a", "x.y", "int", True, 1), ("b", "odd", "double", True, 0),
    ]
    known = spark.createDataFrame(
        [("ODD", "d", "d", "l"), ("zone", "d", "d", "l"), ("source_month", "d", "d", "l")],
        "field string, description string, domain string, lineage string",
    )
    gaps = contracts.dictionary_gaps(frames, known, with_populated=True)
    assert [(r.table_name, r.column_name) for r in gaps.collect()] == [("a", "x.y")]
