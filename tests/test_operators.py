from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fixtures import GOOD, MIXED, REFUSED, raw_frame, rows, zone_frame
from tripfold.operators import answers, contracts, models, profile, snapshot
from tripfold.operators.validate import accepted, rejected, split_counts, validate
from tripfold.sources import landing
from tripfold.sources.dictionary import FIELDS, TABLES, undefined_columns, with_comments


def gold(spark, records, zones=None):
    zones = zone_frame(spark) if zones is None else zones
    validated = validate(raw_frame(spark, records), zones)
    return models.fct_trips(models.stg_trips(accepted(validated)), models.dim_zones(zones))


# -- models ------------------------------------------------------------------------


def test_four_row_fixture(spark):
    records = rows(
        (*GOOD, 15),
        (*GOOD, 15),
        ("2026-01-10 10:00:00", "2026-01-10 10:20:00", 1, 2, 2.0, -5),
        (None, "2026-01-10 10:20:00", 1, 2, 2.0, 15),
    )
    fact = gold(spark, records)
    assert fact.count() == 3
    monthly = models.mart_monthly_activity(fact).first()
    assert (monthly.trip_count, monthly.recorded_fare_amount, monthly.unusual_trip_count) == (
        3, 25, 1,
    )
    route = models.mart_route_duration(fact)
    types = dict(route.dtypes)
    assert types["average_duration_minutes"] == "decimal(31,10)"
    assert types["median_duration_minutes"] == "decimal(27,6)"
    assert route.first().median_duration_minutes == 10
    assert route.first().average_duration_minutes == Decimal("13.3333333333")
    activity = models.mart_pickup_activity(fact)
    assert dict(activity.dtypes)["recorded_fare_amount"] == "decimal(28,2)"
    assert activity.first().pickup_hour == 10


def test_unknown_fares_sum_to_zero_and_are_counted(spark):
    monthly = models.mart_monthly_activity(gold(spark, rows((*GOOD, None), (*GOOD, None)))).first()
    assert monthly.recorded_fare_amount == 0 and monthly.missing_fare_count == 2


def test_even_group_takes_the_lower_median(spark):
    records = rows(
        *[("2026-01-10 10:00:00", f"2026-01-10 10:{m}:00", 1, 2, 2.0, 15) for m in (10, 20, 30, 40)]
    )
    assert models.mart_route_duration(gold(spark, records)).first().median_duration_minutes == 20


def test_a_large_group_has_its_exact_median(spark):
    n = 200_000
    fact = spark.range(n).select(
        F.lit("2026-01").alias("source_month"),
        F.lit(1).alias("pickup_zone_id"),
        F.lit(2).alias("dropoff_zone_id"),
        F.lit("a").alias("pickup_zone_name"),
        F.lit("b").alias("dropoff_zone_name"),
        ((F.col("id") * 7919) % n).cast("decimal(27,6)").alias("duration_minutes"),
        F.lit(False).alias("has_quality_warning"),
    )
    median = models.mart_route_duration(fact).first().median_duration_minutes
    assert median == n // 2 - 1


def test_missing_key_part_gives_no_key_and_keeps_the_record(spark):
    zones = spark.createDataFrame(
        [(None, "B", "Z", "Y", "2026-01"), (1, "B", "Z1", "Y", "2026-01")],
        "zone_id int, borough string, zone_name string, service_zone string, source_month string",
    )
    dim = models.dim_zones(zones)
    assert {r.zone_key for r in dim.collect()} == {None, "2026-01:1"}
    stg = models.stg_trips(
        accepted(validate(raw_frame(spark, rows((*GOOD, 1))), zone_frame(spark)))
    )
    (row,) = models.fct_trips(stg, dim).collect()
    assert row.pickup_zone_name == "Z1" and row.dropoff_zone_name is None
    (same,) = models.fct_trips(stg, dim, small_dim=False).collect()
    assert row.asDict() | {"ingested_at": 0} == same.asDict() | {"ingested_at": 0}


# -- answers -----------------------------------------------------------------------


def test_renamed_zone_is_ranked_separately_and_ties_go_by_key(spark):
    mart = spark.createDataFrame(
        [
            ("2026-01", 1, "Old", 9, 5),
            ("2026-02", 1, "New", 9, 5),
            ("2026-01", 2, "B", 9, 4),
            ("2026-02", 2, "B", 9, 3),
            ("2026-01", 3, "C", 9, 1),
        ],
        "source_month string, pickup_zone_id int, pickup_zone_name string, pickup_hour int, "
        "trip_count bigint",
    )
    ranked = [tuple(r) for r in answers.top_zone_hours(mart, 3).collect()]
    assert ranked == [(2, "B", 9, 7), (1, "New", 9, 5), (1, "Old", 9, 5)]


def test_change_is_against_the_previous_month_present(spark):
    mart = spark.createDataFrame(
        [("2025-12", 9), ("2026-01", 10), ("2026-03", 4)], "pickup_month string, trip_count bigint"
    )
    out = [
        (r.pickup_month, r.trip_count_change)
        for r in answers.monthly_change(mart, "2026-01", "2026-03").collect()
    ]
    assert out == [("2026-01", None), ("2026-03", -6)]


def test_breakdowns_count_a_record_once_per_code(spark):
    validated = validate(raw_frame(spark, MIXED), zone_frame(spark))
    reasons = {r.reason: r.rejected_records_with_reason
               for r in answers.rejection_breakdown(rejected(validated)).collect()}
    assert reasons == REFUSED
    warnings = [tuple(r) for r in answers.warning_breakdown(accepted(validated)).collect()]
    assert len(warnings) == 4 and all(r[2] == 1 for r in warnings)


def test_status_shares_guard_against_zero(spark):
    status = spark.createDataFrame(
        [("2026-01", 8, 4, 2, 1), ("2026-02", 0, 0, 0, 0)],
        "source_month string, input_count bigint, accepted_count bigint, rejected_count bigint, "
        "unusual_count bigint",
    )
    shares = [(r.rejected_pct, r.accepted_warning_pct)
              for r in answers.status_pct(status).collect()]
    assert shares == [(25.0, 25.0), (None, None)]
    assert [r.reconciled for r in answers.status_reconciled(status).orderBy("source_month")
            .collect()] == [False, True]


def test_sensitivity(spark):
    records = rows(
        (*GOOD, 15),
        (*GOOD, 600),
        ("2026-01-10 10:00:00", "2026-01-10 10:00:00", 1, 2, 2.0, 1),
        ("2026-01-10 10:00:00", "2026-01-10 14:00:00", 1, 2, 2.0, 1),
    )
    row = answers.sensitivity(
        accepted(validate(raw_frame(spark, records), zone_frame(spark)))
    ).first()
    assert (row.accepted, row.fare_all, row.fare_without_fare_warning) == (4, 617, 17)
    assert (row.zero_duration, row.over_180_minutes) == (1, 1)
    assert [float(p) for p in row.duration_percentiles] == [10.0, 240.0, 240.0]


# -- contracts ---------------------------------------------------------------------


def test_zone_violations(spark):
    zones = zone_frame(spark, ids=(1, 1, 2, None)).union(zone_frame(spark, "2026-02"))
    out = {(r.source_month, r.zone_id, r.violation)
           for r in contracts.zone_violations(zones).collect()}
    assert out == {("2026-01", 1, "repeated_id"), ("2026-01", None, "missing_id")}


@pytest.mark.parametrize(
    "states, expected",
    [
        ([], {("2026-01", "not_prepared")}),
        ([("2026-01", "FAILED")], {("2026-01", "not_success")}),
        ([("2026-02", "SUCCESS")], {("2026-01", "not_prepared")}),
        ([("2026-01", "SUCCESS"), ("2026-02", None)], {("2026-02", "not_success")}),
        ([("2026-01", "SUCCESS"), ("2026-02", "SUCCESS")], set()),
    ],
)
def test_readiness(spark, states, expected):
    status = spark.createDataFrame(states, "source_month string, status string")
    requested = contracts.requested_frame(status, ["2026-01"])
    found = {tuple(r) for r in contracts.readiness_violations(status, requested).collect()}
    assert found == expected
    with pytest.raises(ValueError):
        contracts.requested_frame(status, [])


def test_declared_domains(spark):
    frame = spark.createDataFrame(
        [("m", 1, "Y", 1.0, -0.5), ("m", 3, "N", 1.5, 0.0), ("m", None, "?", -1.0, None)],
        "source_month string, VendorID int, store_and_fwd_flag string, passenger_count double, "
        "Airport_fee double",
    )
    out = {r.column_name: (r.conforming, r.violating, r.null_count)
           for r in contracts.domain_conformance(frame, contracts.trip_domains()).collect()}
    assert out == {
        "VendorID": (1, 1, 1),
        "store_and_fwd_flag": (2, 1, 0),
        "passenger_count": (1, 2, 0),
        "airport_fee": (1, 1, 1),
    }
    with pytest.raises(ValueError):
        contracts.domain_conformance(frame.select("source_month"), contracts.trip_domains())


def test_dictionary(spark):
    frame = raw_frame(spark, MIXED).withColumn("surprise", F.lit(None).cast("int"))
    frame = frame.withColumnRenamed("PULocationID", "pulocationid")
    report = {r.column_name: r
              for r in contracts.dictionary_report(frame, "bronze.yellow_trips").collect()}
    assert len(report) == len(frame.columns)
    assert report["pulocationid"].is_defined  # names match without regard to case
    assert report["tpep_dropoff_datetime"].populated == 8
    (gap,) = contracts.dictionary_gaps({"bronze.yellow_trips": frame}).collect()
    assert tuple(gap) == ("bronze.yellow_trips", "surprise", "int")
    two = contracts.dictionary({"a": frame, "b": zone_frame(spark)}).collect()
    assert {(r.table_name, r.is_defined) for r in two} == {("a", True), ("a", False), ("b", True)}
    assert all(r.description and r.domain and r.lineage for r in two if r.is_defined)
    assert undefined_columns(frame) == ["surprise"]
    assert with_comments(frame).columns == frame.columns
    assert len(TABLES) == 16 and all(len(entry) == 3 for entry in FIELDS.values())


# -- profile -----------------------------------------------------------------------


def test_profile_of_awkward_values(spark):
    frame = spark.createDataFrame(
        [
            ("m", 1.0, " ", 1),
            ("m", float("nan"), "a", 2),
            ("m", None, None, None),
            ("m", 3.0, "b", 4),
            ("n", None, "", 7),
        ],
        "source_month string, d double, s string, i int",
    )
    out = {(r.source_month, r.column_name): r for r in profile.column_profile(frame).collect()}
    assert len(out) == 6
    d = out["m", "d"]
    assert (d.total, d.missing, d.missing_pct) == (4, 2, 50.0)
    assert (d.min_value, d.max_value, d.quartiles) == ("1.0", "NaN", [1.0, 1.0, 3.0])
    s = out["m", "s"]
    assert (s.missing, s.quartiles, s.data_type) == (2, None, "string")
    assert out["m", "i"].quartiles == [1.0, 2.0, 4.0] and out["n", "s"].missing == 1
    assert out["n", "d"].min_value is None


def test_approximate_distinct_is_close(spark):
    frame = spark.range(20_000).select(
        F.lit("m").alias("source_month"), (F.col("id") % 5000).alias("v")
    )
    (row,) = profile.column_profile(frame).collect()
    assert abs(row.distinct_approx - 5000) <= 0.15 * 5000  # three standard errors


def test_duplicates_group_nulls_nans_and_zeros(spark):
    nan = float("nan")
    frame = spark.createDataFrame(
        [("m", nan, None), ("m", nan, None), ("m", 0.0, "a"), ("m", -0.0, "a"), ("m", -0.0, "a"),
         ("m", 1.0, "a"), ("n", 0.0, "a")],
        "source_month string, x double, y string",
    )
    groups = profile.duplicate_groups(frame)
    assert sorted(r.copies for r in groups.collect()) == [2, 3]
    assert [tuple(r) for r in profile.duplicate_excess(groups).collect()] == [("m", 2, 3)]
    assert [tuple(r) for r in profile.duplicate_counts(frame).collect()] == [("m", 2, 3)]


def test_rows_that_differ_in_what_is_null_are_no_duplicates(spark):
    frame = spark.createDataFrame(
        [("m", None, "a"), ("m", "a", None), ("m", None, None), ("m", None, "a")],
        "source_month string, x string, y string",
    )
    assert [tuple(r) for r in profile.duplicate_counts(frame).collect()] == [("m", 1, 1)]
    assert profile.duplicate_counts(frame.limit(0)).collect() == []
    both = profile.of_tables({"p": frame, "q": frame.drop("y")}, profile.duplicate_counts)
    assert {tuple(r) for r in both.collect()} == {("p", "m", 1, 1), ("q", "m", 1, 2)}


def test_duplicates_ignore_provenance(spark):
    frame = raw_frame(spark, MIXED)
    again = frame.withColumn("ingestion_run_id", F.lit("other"))
    assert profile.duplicate_groups(frame).count() == 1
    assert profile.duplicate_groups(frame.union(again)).agg(F.sum("copies")).first()[0] == 18


def test_category_counts(spark):
    frame = spark.createDataFrame(
        [("m", 1, "Y"), ("m", 1, None), ("m", 2, "Y")],
        "source_month string, VendorID int, store_and_fwd_flag string",
    )
    wanted = ("VendorID", "RatecodeID", "store_and_fwd_flag")
    out = {(r.column_name, r.value): r.row_count
           for r in profile.category_counts(frame, wanted).collect()}
    assert out == {
        ("VendorID", "1"): 2,
        ("VendorID", "2"): 1,
        ("store_and_fwd_flag", "Y"): 2,
        ("store_and_fwd_flag", None): 1,
    }


# -- snapshots ---------------------------------------------------------------------


def test_snapshot_diff_kinds(spark):
    raw = raw_frame(spark, MIXED)
    before = snapshot.snapshot_metrics({"a": raw, "zones": zone_frame(spark)})
    same = snapshot.snapshot_metrics({"a": raw.repartition(3), "zones": zone_frame(spark)})
    assert snapshot.snapshot_diff(before, same).isEmpty()
    after = snapshot.snapshot_metrics(
        {"a": raw.withColumn("fare_amount", F.lit(None)), "b": raw}
    )
    changes = {(r.table_name, r.change) for r in snapshot.snapshot_diff(before, after).collect()}
    assert changes == {("a", "changed"), ("zones", "removed"), ("b", "added")}


def test_validated_records_give_both_tables_in_one_aggregate(spark):
    validated = validate(raw_frame(spark, MIXED), zone_frame(spark))
    once = snapshot.snapshot_metrics({}, validated)
    apart = snapshot.snapshot_metrics(
        {"silver.trips": accepted(validated), "silver.rejected_trips": rejected(validated)}
    )
    assert snapshot.snapshot_diff(once, apart).isEmpty() and once.count() == 2


def test_raw_zone_contract(spark):
    lines = [("a", "1"), ("a", "01"), ("a", "2"), ("b", None), ("b", "x"), ("c", " "), ("z", "x")]
    raw = spark.createDataFrame(lines, "source_month string, LocationID string")
    asked = spark.createDataFrame([(m,) for m in "abcd"], "source_month string")
    found = contracts.raw_zone_violations(raw, asked).collect()
    assert {tuple(r) for r in found} == {
        ("a", 1, 2, "repeated_id"),
        ("b", None, 2, "uncastable_id"),
        ("c", None, 1, "uncastable_id"),
        ("d", None, 0, "empty_month"),
    }


def test_gates_stop_an_answer(spark):
    answer, none = spark.range(3), spark.range(0)
    assert answers.gated(answer, {"a": none, "b": none}).count() == 3
    with pytest.raises(Exception, match="answers are blocked by b, c"):
        answers.gated(answer, {"a": none, "c": spark.range(2), "b": answer}).collect()


# -- landing -----------------------------------------------------------------------


def test_landing_audit(spark, tmp_path):
    def put(month, name, content):
        target = tmp_path / month / name
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(content)

    sound = b"PAR1examplebytesPAR1"
    for month in ("2026-01", "2026-02", "2026-03", "2026-04", "2026-05"):
        put(month, "taxi_zone_lookup.csv", b"LocationID\n")
    put("2026-01", "yellow_tripdata_2026-01.parquet", sound)
    put("2026-02", "yellow_tripdata_2026-02.parquet", b"PAR1truncated")
    put("2026-03", "yellow_tripdata_2026-03.parquet", b"")
    put("2026-04", "yellow_tripdata_2026-01.parquet", sound)
    put("2026-05", "yellow_tripdata_2026-05.parquet/part-0.parquet", sound)
    put("2026-05", "yellow_tripdata_2026-05.parquet/part-1.parquet", b"PAR1")
    put("2026-05", "yellow_tripdata_2026-05.parquet/_SUCCESS", b"")
    months = ["2026-01", "2026-02", "2026-03", "2026-04", "2026-05", "2026-06"]
    audit = landing.landing_audit(spark, str(tmp_path), months).collect()
    trips = "yellow_tripdata_{}.parquet"
    assert {(r.source_month, r.file_name, r.violation) for r in audit if r.violation} == {
        ("2026-02", trips.format("2026-02"), "incomplete_parquet"),
        ("2026-03", trips.format("2026-03"), "empty_file"),
        ("2026-04", trips.format("2026-01"), "unexpected_name"),
        ("2026-04", trips.format("2026-04"), "missing_file"),
        ("2026-05", trips.format("2026-05"), "incomplete_parquet"),
        ("2026-06", trips.format("2026-06"), "missing_file"),
        ("2026-06", "taxi_zone_lookup.csv", "missing_file"),
    }
    assert sum(r.violation is None for r in audit) == 7
    listed = landing.landing_audit(spark, str(tmp_path), months, ends=False)
    assert {r.violation for r in listed.collect()} == {
        None, "empty_file", "unexpected_name", "missing_file",
    }
    plan = listed._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan  # no file is opened
    nothing = landing.landing_audit(spark, str(tmp_path), ["2031-01"]).collect()
    assert [r.violation for r in nothing] == ["missing_file"] * 2


def test_file_names(spark):
    assert landing.trip_filename("2026-01") == "yellow_tripdata_2026-01.parquet"
    named = spark.range(1).select(landing.filename_column(F.lit("2026-01"))).first()[0]
    assert named == landing.trip_filename("2026-01")
    with pytest.raises(ValueError):
        landing.trip_filename("../2026-01")


def test_split_counts_of_all_months_in_one_pass(spark):
    frame = raw_frame(spark, MIXED).union(raw_frame(spark, MIXED, "2026-02"))
    zones = zone_frame(spark).union(zone_frame(spark, "2026-02"))
    counts = {r.source_month: r.accepted_count
              for r in split_counts(validate(frame, zones)).collect()}
    assert counts == {"2026-01": 5, "2026-02": 5}
