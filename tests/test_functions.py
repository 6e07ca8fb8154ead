import string

import pytest
from pyspark.sql import functions as F

from tripfold.config import FeedConfig, Layer, check_run_id
from tripfold.functions.durations import wall_minutes, wall_seconds
from tripfold.functions.lookups import fits_broadcast, frequent_keys, lookup_bytes, lookup_join
from tripfold.functions.months import check_month, is_month, month_contract, month_of, parse_months
from tripfold.functions.rules import Rule, tag

MONTH = "2031-07"
# One character lost, one too many, a month that no year has, a year that is none.
BAD_MONTHS = sorted(
    {MONTH[:k] + MONTH[k + 1 :] for k in range(len(MONTH))}
    | {MONTH[:k] + odd + MONTH[k:] for k in range(len(MONTH) + 1) for odd in "'/\n 0x"}
    | {f"2031-{number:02}" for number in (0, *range(13, 100, 29))}
    | {"0000-07", MONTH.replace("-", "/")}
)


@pytest.mark.parametrize("value", [*BAD_MONTHS, "", None])
def test_bad_month_is_refused(value):
    with pytest.raises(ValueError):
        check_month(value)


def test_month_lists():
    assert parse_months("2026-02, 2026-01") == ["2026-01", "2026-02"]
    for text in ("", "2026-01,2026-01", "2026-13"):
        with pytest.raises(ValueError):
            parse_months(text)


def test_month_column_agrees_with_the_parameter_check(spark):
    frame = spark.createDataFrame([(m,) for m in [*BAD_MONTHS, MONTH, None]], "m string")
    valid = {row.m: row.ok for row in frame.select("m", is_month(F.col("m")).alias("ok")).collect()}
    assert valid == {**{m: False for m in BAD_MONTHS}, MONTH: True, None: False}
    report = {r.month_text: r for r in month_contract(frame.union(frame), "m").collect()}
    assert report[MONTH].row_count == 2 and report[MONTH].is_valid
    assert not report[None].is_valid


def test_names_are_quoted_and_plain():
    config = FeedConfig(catalog="lake", prefix="Cabs2")
    assert config.name("ops") == "`lake`.`Cabs2_ops`"
    assert config.name(Layer.GOLD, "fares") == "`lake`.`Cabs2_gold`.`fares`"
    odd = [f"cabs{mark}" for mark in string.punctuation + string.whitespace if mark != "_"]
    for value in [*odd, "2cabs", "", "caf\u00e9"]:
        for part in ("catalog", "prefix", "table_format"):
            with pytest.raises(ValueError):
                FeedConfig(**{part: value})
        with pytest.raises(ValueError):
            config.name("silver", value)
    with pytest.raises(ValueError):
        config.name("copper")


def test_run_ids():
    assert check_run_id("x" * 256)
    for value in ("", "x" * 257, None):
        with pytest.raises(ValueError):
            check_run_id(value)


MOMENTS = [
    ("2026-03-08 02:59:00", "2026-03-08 03:01:00", 120, "2.000000"),  # clocks go forward
    ("2026-01-01 00:00:00.9", "2026-01-01 00:00:10.1", 9, "0.150000"),
    ("2026-01-01 00:00:10.1", "2026-01-01 00:00:00.9", -9, "-0.150000"),
    ("2026-01-01 00:00:00", "2026-01-01 00:00:00", 0, "0.000000"),
    ("2026-01-01 00:00:00", "2026-01-01 00:00:05", 5, "0.083333"),
    (None, "2026-01-01 00:00:05", None, None),
]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "America/Sao_Paulo"])
def test_wall_clock_does_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        frame = spark.createDataFrame(MOMENTS, "a string, b string, s long, m string").select(
            F.col("a").cast("timestamp_ntz").alias("a"),
            F.col("b").cast("timestamp_ntz").alias("b"),
            "s",
            "m",
        )
        out = frame.select(
            "s",
            "m",
            wall_seconds(F.col("a"), F.col("b")).alias("seconds"),
            wall_minutes(F.col("a"), F.col("b")).alias("minutes"),
            month_of(F.col("b")).alias("month"),
        )
        assert out.schema["minutes"].dataType.simpleString() == "decimal(27,6)"
        for row in out.collect():
            assert row.seconds == row.s
            assert (None if row.minutes is None else str(row.minutes)) == row.m
            assert row.month in ("2026-01", "2026-03")
        # Midnight does not exist on this day in Sao Paulo.
        edge = spark.sql("SELECT timestamp_ntz'2018-11-04 00:00:00' AS t")
        assert edge.select(month_of(F.col("t"))).first()[0] == "2018-11"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_tags_keep_rule_order_and_ignore_null_conditions(spark):
    frame = spark.createDataFrame(
        [(1, 1), (None, 1), (None, None), (5, 5), (5, None)], "a int, b int"
    )
    rules = [Rule("second", F.col("b") < 3), Rule("first", F.col("a") < 3)]
    assert [r[0] for r in frame.select(tag(rules)).collect()] == [
        ["second", "first"],
        ["second"],
        [],
        [],
        [],
    ]
    empty = frame.select(tag([]).alias("t"))
    assert empty.schema["t"].dataType.simpleString() == "array<string>"
    assert [r.t for r in empty.collect()] == [[]] * 5


def test_lookup_size_grows_with_rows_and_text(spark):
    small = spark.range(10).select(F.col("id").cast("string").alias("name"))
    large = spark.range(10).select(F.lit("x" * 1000).alias("name"))
    assert lookup_bytes(small) < lookup_bytes(large)
    assert lookup_bytes(small.limit(0)) == 0
    assert fits_broadcast(small) and not fits_broadcast(large, limit=1000)


@pytest.mark.parametrize("hot", ["one zone", "no zone", "one row", "two zones"])
def test_a_hot_key_is_spread_over_all_tasks(spark, hot):
    """Nine records in ten hold one key; adaptive handling is off, so the plan alone spreads."""
    number, tasks = 200_000, 8
    key = {
        "one zone": "if(id % 10 < 9, 7, id % 5000)",
        "no zone": "if(id % 10 < 9, null, id % 5000)",
        "one row": "if(id % 10 < 9, 7, id % 5000)",
        "two zones": "if(id % 10 < 6, 7, if(id % 10 < 9, 9, id % 5000))",
    }[hot]
    value = "if(id % 10 < 9, 0, id)" if hot == "one row" else "id"
    frame = spark.range(number).selectExpr(f"cast({key} as int) zone", f"{value} v", "'m' month")
    lookup = spark.range(4000).selectExpr("cast(id as bigint) zone_id", "'m' lookup_month", "id * 2 name")
    keys = {"month": "lookup_month", "zone": "zone_id"}
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(tasks))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = lookup_join(frame, lookup, keys, small=False)
        assert joined.columns == ["zone", "v", "month", "name"]
        sizes = sorted(
            r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()
        )
        assert len(sizes) == tasks and sum(sizes) == number
        assert sizes[-1] < 2 * sizes[tasks // 2]
        plain = lookup_join(frame, lookup, keys, small=True)
        assert joined.exceptAll(plain).isEmpty() and plain.exceptAll(joined).isEmpty()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_few_keys_are_frequent(spark):
    frame = spark.range(10_000).selectExpr("if(id < 5000, -1, id) k")
    found = frequent_keys(frame, F.col("k"), 4).collect()
    (one,) = found  # the sketch may count too many, never too few
    assert one["__frequent"] == -1 and 32 <= one["__copies"] <= 34
    assert frequent_keys(frame.limit(0), F.col("k"), 4).collect() == []
    even = spark.range(10_000).selectExpr("id % 1000 k")
    assert frequent_keys(even, F.col("k"), 8).count() == 0
