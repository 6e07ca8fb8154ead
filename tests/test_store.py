import pytest
from pyspark.sql import functions as F

from fixtures import MIXED, raw_frame
from tripfold.config import FeedConfig
from tripfold.sources.store import MonthStore


@pytest.fixture
def store(spark, request):
    name = "store_" + "".join(c if c.isalnum() else "_" for c in request.node.name)
    made = MonthStore(spark, FeedConfig(prefix=name))
    made.bootstrap()
    yield made
    for layer in ("bronze", "silver", "gold", "ops"):
        spark.sql(f"DROP SCHEMA {made.config.name(layer)} CASCADE")


def counts(store, name="rows"):
    return {
        row.source_month: row.n
        for row in store.table("silver", name)
        .groupBy("source_month")
        .agg(F.count("*").alias("n"))
        .collect()
    }


def month_rows(spark, month, n):
    return spark.range(n).select("id", F.lit(month).alias("source_month"))


def test_replacing_a_month_leaves_the_others(store):
    spark = store.spark
    store.replace_month(month_rows(spark, "2026-01", 3), "silver", "rows", "2026-01")
    store.replace_month(month_rows(spark, "2026-02", 5), "silver", "rows", "2026-02")
    assert counts(store) == {"2026-01": 3, "2026-02": 5}
    for _ in range(2):
        store.replace_month(month_rows(spark, "2026-01", 4), "silver", "rows", "2026-01")
        assert counts(store) == {"2026-01": 4, "2026-02": 5}


@pytest.mark.parametrize("mode", ["static", "dynamic"])
@pytest.mark.parametrize("within", [(), ("half",)])
def test_an_empty_frame_empties_the_month(store, mode, within):
    spark = store.spark
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        for month in ("2026-01", "2026-02"):
            frame = month_rows(spark, month, 6)
            if within:
                frame = frame.withColumn("half", (F.col("id") % 2).cast("string"))
            store.replace_month(frame, "silver", "rows", month, within)
        store.replace_month(frame.limit(0), "silver", "rows", "2026-01", within)
        assert counts(store) == {"2026-02": 6}
        if within:
            odd = frame.where("half = '1'")
            store.replace_month(odd, "silver", "rows", "2026-02", within)
            assert counts(store) == {"2026-02": 3}
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")


def test_rows_of_another_month_are_refused(store):
    spark = store.spark
    store.replace_month(month_rows(spark, "2026-01", 2), "silver", "rows", "2026-01")
    mixed = month_rows(spark, "2026-01", 2).union(month_rows(spark, "2026-02", 1))
    with pytest.raises(Exception, match="outside month"):
        store.replace_month(mixed, "silver", "rows", "2026-01")
    with pytest.raises(ValueError):
        store.replace_month(mixed, "silver", "rows", "2026-13")


def test_columns_must_match_the_table_but_may_come_in_any_order(store):
    spark = store.spark
    first = month_rows(spark, "2026-01", 2).withColumn("name", F.lit("a"))
    store.replace_month(first, "silver", "rows", "2026-01")
    store.replace_month(first.select("source_month", "name", "id"), "silver", "rows", "2026-01")
    assert {tuple(r) for r in store.table("silver", "rows").select("id", "name").collect()} == {
        (0, "a"),
        (1, "a"),
    }
    for wrong in (first.drop("name"), first.withColumn("extra", F.lit(1))):
        with pytest.raises(ValueError, match="columns differ"):
            store.replace_month(wrong, "silver", "rows", "2026-01")


def test_a_month_read_is_pruned_to_its_partition(store):
    spark = store.spark
    for month in ("2026-01", "2026-02"):
        store.replace_month(month_rows(spark, month, 3), "silver", "rows", month)
    plan = store.table("silver", "rows", "2026-01")
    assert {f.split("source_month=")[1][:7] for f in plan.inputFiles()} == {"2026-01"}
    assert plan.count() == 3
    with pytest.raises(ValueError):
        store.table("silver", "rows", "' OR 1=1")


def test_a_month_may_be_rewritten_from_itself_through_staging(store):
    spark = store.spark
    for month in ("2026-01", "2026-02"):
        store.replace_month(month_rows(spark, month, 6), "silver", "rows", month)
    kept = store.table("silver", "rows", "2026-01").where("id < 2")
    store.replace_month_via_staging(kept, "silver", "rows", "2026-01")
    assert counts(store) == {"2026-01": 2, "2026-02": 6}


def test_status_has_one_row_per_month_and_events_accumulate(store):
    store.record("month_status", "2026-01", run_id="r1", status="INGESTED", input_count=7)
    store.record(
        "month_status", "2026-02", run_id="r1", status="SUCCESS", input_count=1, accepted_count=1
    )
    store.record("month_status", "2026-01", run_id="r2", status="RUNNING")
    rows = {r.source_month: r for r in store.table("ops", "month_status").collect()}
    assert set(rows) == {"2026-01", "2026-02"}
    assert rows["2026-01"].run_id == "r2" and rows["2026-01"].input_count is None
    assert rows["2026-02"].accepted_count == 1 and rows["2026-02"].rejected_count is None
    about = {"month": "2026-01", "run_id": "r2", "service": "ingestion"}
    store.record("run_events", **about, status="STARTED")
    store.record("run_events", **about, status="FAILED", error_type="ValueError")
    with pytest.raises(ValueError, match="outcome"):
        store.record("run_events", **about, outcome="FAILED")
    events = store.table("ops", "run_events").orderBy("event_time").collect()
    assert [(e.service, e.status, e.error_type) for e in events] == [
        ("ingestion", "STARTED", None),
        ("ingestion", "FAILED", "ValueError"),
    ]
    store.bootstrap()  # keeps what is there
    assert store.table("ops", "run_events").count() == 2


def test_whole_table_replacement_and_views(store):
    spark = store.spark
    frame = month_rows(spark, "2026-01", 3).union(month_rows(spark, "2026-02", 2))
    assert store.replace_table(frame, "gold", "marts").count() == 5
    assert store.replace_table(frame.where("id = 0"), "gold", "marts").count() == 2
    view = store.replace_view("gold", "v", f"SELECT id FROM {store.config.name('gold', 'marts')}")
    assert view.columns == ["id"] and view.count() == 2
    assert store.exists("gold", "v") and not store.exists("gold", "nothing")


def test_an_aggregate_is_written_as_few_files_per_month(store):
    frame = store.spark.range(1000, numPartitions=8).select(
        "id", F.format_string("2026-%02d", F.col("id") % 3 + 1).alias("source_month")
    )
    table = store.replace_table(frame, "gold", "few", rebalance=True)
    assert table.count() == 1000 and len(table.inputFiles()) == 3


def test_tables_carry_dictionary_comments(store):
    store.replace_month(raw_frame(store.spark, MIXED), "bronze", "yellow_trips", "2026-01")
    described = {
        row.col_name: row.comment
        for row in store.spark.sql(
            f"DESCRIBE {store.config.name('bronze', 'yellow_trips')}"
        ).collect()
    }
    assert described["fare_amount"].startswith("Fare, USD. Domain:")


@pytest.mark.parametrize(
    "stored, arriving, value, kept",
    [
        ("bigint", "double", "1.7", None),
        ("int", "bigint", "5000000000", None),
        ("decimal(18,2)", "double", "2.349", None),
        ("double", "bigint", "9007199254740993", None),
        ("bigint", "int", "7", 7),
        ("double", "int", "7", 7.0),
        ("decimal(20,2)", "int", "7", 7),
    ],
)
def test_a_month_of_another_type_is_kept_whole_or_refused(store, stored, arriving, value, kept):
    spark = store.spark

    def rows(kind, text, month):
        return spark.range(1).select(
            F.lit(text).cast(kind).alias("amount"), F.lit(month).alias("source_month")
        )

    store.replace_month(rows(stored, "1", "2026-01"), "silver", "rows", "2026-01")
    later = rows(arriving, value, "2026-02")
    if kept is None:
        with pytest.raises(ValueError, match="could lose values"):
            store.replace_month(later, "silver", "rows", "2026-02")
        assert counts(store) == {"2026-01": 1}
    else:
        store.replace_month(later, "silver", "rows", "2026-02")
        assert store.table("silver", "rows", "2026-02").first().amount == kept


def test_column_names_match_without_regard_to_case(store):
    spark = store.spark
    for month, name in (("2026-01", "airport_fee"), ("2026-02", "Airport_fee")):
        frame = month_rows(spark, month, 2).withColumn(name, F.lit(1.5))
        store.replace_month(frame, "silver", "rows", month)
    assert store.table("silver", "rows").agg(F.sum("airport_fee")).first()[0] == 6.0
    before = spark.conf.get("spark.sql.caseSensitive")
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        both = frame.withColumn("airport_fee", F.lit(2.5))
        with pytest.raises(ValueError, match="case alone"):
            store.replace_month(both, "silver", "rows", "2026-02")
    finally:
        spark.conf.set("spark.sql.caseSensitive", before)


def test_a_write_that_fails_leaves_the_old_month(store):
    spark = store.spark
    for within in ((), ("half",)):
        name = f"rows_{len(within)}"
        frame = month_rows(spark, "2026-01", 6).withColumn("half", (F.col("id") % 2).cast("string"))
        store.replace_month(frame, "silver", name, "2026-01", within)
        # The second task fails after the first has written its files.
        failing = frame.unionByName(frame.withColumn("id", F.col("id") + 100)).withColumn(
            "id", F.when(F.col("id") < 104, F.col("id")).otherwise(F.raise_error(F.lit("torn")).cast("bigint"))
        )
        with pytest.raises(Exception, match="torn"):
            store.replace_month(failing, "silver", name, "2026-01", within)
        assert counts(store, name) == {"2026-01": 6}
        assert {r.id for r in store.table("silver", name).collect()} == set(range(6))


def test_a_reader_under_way_outlives_one_replacement(store):
    import os

    spark = store.spark
    store.replace_month(month_rows(spark, "2026-01", 3), "silver", "rows", "2026-01")
    first = spark.read.parquet(*store.table("silver", "rows").inputFiles())
    store.replace_month(month_rows(spark, "2026-01", 4), "silver", "rows", "2026-01")
    assert first.count() == 3 and counts(store) == {"2026-01": 4}
    paths = [f.removeprefix("file://") for f in first.inputFiles()]
    store.replace_month(month_rows(spark, "2026-01", 5), "silver", "rows", "2026-01")
    assert not any(map(os.path.exists, paths)) and counts(store) == {"2026-01": 5}


def test_partitions_below_a_month_come_and_go(store):
    spark = store.spark
    frame = month_rows(spark, "2026-01", 6).withColumn("half", (F.col("id") % 2).cast("string"))
    for kept, n in (("half = '1'", 3), ("id >= 0", 6), ("half = '0'", 3), ("id < 0", 0), ("id > 4", 1)):
        store.replace_month(frame.where(kept), "silver", "rows", "2026-01", ("half",))
        assert store.table("silver", "rows").count() == n
