from collections import Counter

import pytest
from pyspark.sql import functions as F

from fixtures import ALL_BAD, GOOD, KEPT_FARES, MIXED, raw_frame, rows, zone_frame
from tripfold.operators.validate import (
    Thresholds,
    accepted,
    normalize,
    rejected,
    split_counts,
    validate,
)

SILVER_TYPES = {
    "pickup_at": "timestamp_ntz",
    "dropoff_at": "timestamp_ntz",
    "pickup_zone_id": "int",
    "dropoff_zone_id": "int",
    "trip_distance_miles": "double",
    "fare_amount": "decimal(18,2)",
    "total_amount": "decimal(18,2)",
    "source_month": "string",
    "source_filename": "string",
    "ingested_at": "timestamp",
    "ingestion_run_id": "string",
    "rejection_reasons": "array<string>",
    "quality_warnings": "array<string>",
    "duration_minutes": "decimal(27,6)",
}


def codes(frame):
    return [
        (row.rejection_reasons, row.quality_warnings)
        for row in frame.select("rejection_reasons", "quality_warnings").collect()
    ]


def one(spark, *spec, **options):
    return codes(validate(raw_frame(spark, rows(spec)), zone_frame(spark), **options))[0]


def test_mixed_records(spark):
    out = validate(raw_frame(spark, MIXED), zone_frame(spark))
    assert dict(out.dtypes) == SILVER_TYPES
    assert Counter(map(str, codes(out))) == Counter(
        map(
            str,
            [
                *[([], [])] * 3,
                (["missing_or_invalid_timestamp"], []),
                (["reversed_journey"], []),
                (["reversed_journey", "invalid_pickup_zone"], []),
                (["invalid_dropoff_zone"], []),
                ([], ["unusual_distance", "unusual_fare", "unusual_total"]),
                ([], ["pickup_outside_source_month"]),
            ],
        )
    )
    counts = split_counts(out).first().asDict()
    assert counts == {
        "source_month": "2026-01",
        "input_count": 9,
        "accepted_count": 5,
        "rejected_count": 4,
        "unusual_count": 2,
    }
    assert accepted(out).agg(F.sum("fare_amount")).first()[0] == KEPT_FARES
    assert accepted(out).count() + rejected(out).count() == 9


def test_reasons_co_occur_in_rule_order(spark):
    reasons, _ = one(
        spark, "2026-01-10 10:10:00", "2026-01-10 10:00:00", 8, 9, 2.0, 15
    )
    assert reasons == ["reversed_journey", "invalid_pickup_zone", "invalid_dropoff_zone"]
    assert one(spark, None, None, 1, None, 2.0, 15)[0] == [
        "missing_or_invalid_timestamp",
        "invalid_dropoff_zone",
    ]


@pytest.mark.parametrize(
    "distance, warned",
    [(0.0, True), (0.01, False), (100.0, False), (100.01, True), (float("nan"), True),
     (None, True), (-1.0, True)],
)
def test_distance_limits(spark, distance, warned):
    _, warnings = one(spark, *GOOD[:4], distance, 15)
    assert warnings == (["unusual_distance"] if warned else [])


@pytest.mark.parametrize(
    "fare, total, expected",
    [
        (0, 0, []),
        (500, 500, []),
        (500.01, 9999, ["unusual_fare"]),
        (None, 1, ["unusual_fare"]),
        (-0.01, 1, ["unusual_fare"]),
        (1, -0.01, ["unusual_total"]),
        (1, None, ["unusual_total"]),
    ],
)
def test_amount_limits(spark, fare, total, expected):
    assert one(spark, *GOOD, fare, total) == ([], expected)


def test_zero_duration_is_accepted(spark):
    out = validate(
        raw_frame(spark, rows((GOOD[0], GOOD[0], 1, 2, 2.0, 15))), zone_frame(spark)
    ).first()
    assert out.rejection_reasons == [] and out.duration_minutes == 0


def test_clock_change_is_not_a_reversal(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        frame = raw_frame(
            spark,
            rows(("2026-03-08 02:59:00", "2026-03-08 03:01:00", 1, 2, 2.0, 15)),
            "2026-03",
        )
        row = validate(frame, zone_frame(spark, "2026-03")).first()
        assert row.rejection_reasons == [] and row.duration_minutes == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_values_that_cannot_be_cast_become_null(spark):
    text = raw_frame(spark, rows((*GOOD, 15))).select(
        F.lit("not a time").alias("tpep_pickup_datetime"),
        F.lit("2026-01-10 10:10:00").alias("tpep_dropoff_datetime"),
        F.lit("first").alias("PULocationID"),
        F.lit(2.9).alias("DOLocationID"),
        F.lit("far").alias("trip_distance"),
        F.lit("99999999999999999999").alias("fare_amount"),
        F.lit("12.345").alias("total_amount"),
        "source_month",
        "source_filename",
        "ingested_at",
        "ingestion_run_id",
    )
    row = validate(text, zone_frame(spark)).first()
    assert row.pickup_at is None and row.pickup_zone_id is None and row.fare_amount is None
    assert row.trip_distance_miles is None
    assert row.dropoff_zone_id == 2 and str(row.total_amount) == "12.35"
    assert row.rejection_reasons == ["missing_or_invalid_timestamp", "invalid_pickup_zone"]
    assert row.quality_warnings == ["unusual_distance", "unusual_fare"]
    assert row.duration_minutes is None


def test_missing_column_is_refused(spark):
    with pytest.raises(ValueError, match="fare_amount"):
        normalize(raw_frame(spark, MIXED).drop("fare_amount"))
    with pytest.raises(ValueError, match="PULocationID"):
        normalize(raw_frame(spark, MIXED).withColumnRenamed("PULocationID", "pulocationid"))


def test_each_month_uses_its_own_snapshot(spark):
    both = raw_frame(spark, rows((*GOOD, 15)), "2026-01").union(
        raw_frame(spark, rows((*GOOD, 15)), "2026-02")
    )
    zones = zone_frame(spark, "2026-01").union(zone_frame(spark, "2026-02", ids=(2,)))
    out = {r.source_month: r.rejection_reasons for r in validate(both, zones).collect()}
    assert out == {"2026-01": [], "2026-02": ["invalid_pickup_zone"]}


def test_repeated_zone_does_not_repeat_records(spark):
    doubled = zone_frame(spark).union(zone_frame(spark))
    assert validate(raw_frame(spark, MIXED), doubled).count() == 9


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_large_lookup_gives_the_same_rows(spark, threshold):
    """Past the broadcast limit the lookup joins shuffle, with a hot zone in the data."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        raw = raw_frame(spark, MIXED * 50 + ALL_BAD)
        zones = zone_frame(spark, ids=range(1, 50))
        small = Counter(map(str, codes(validate(raw, zones, small_zones=True))))
        large = Counter(map(str, codes(validate(raw, zones, small_zones=False))))
        assert small == large
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_thresholds_are_parameters(spark):
    limits = Thresholds(max_distance=1, max_fare=10)
    assert one(spark, *GOOD, 15, limits=limits)[1] == ["unusual_distance", "unusual_fare"]


def test_partitioning_does_not_matter(spark):
    raw = raw_frame(spark, MIXED * 10)
    zones = zone_frame(spark)
    apart = Counter(map(str, codes(validate(raw.repartition(7), zones))))
    together = Counter(map(str, codes(validate(raw.coalesce(1), zones))))
    assert apart == together


def test_validation_runs_on_a_stream(spark, tmp_path):
    raw_frame(spark, MIXED).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(raw_frame(spark, MIXED).schema).parquet(str(tmp_path / "in"))
    query = (
        validate(stream, zone_frame(spark))
        .writeStream.trigger(availableNow=True)
        .option("checkpointLocation", str(tmp_path / "progress"))
        .format("parquet")
        .start(str(tmp_path / "out"))
    )
    query.awaitTermination(120)
    out = spark.read.parquet(str(tmp_path / "out"))
    assert split_counts(out).first().accepted_count == 5
