import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fixtures import ALL_BAD, CLEAN, GOOD, KEPT_FARES, MIXED, REFUSED, land, rows
from tripfold.config import FeedConfig
from tripfold.operators.checks import CHECKS, POST_CHECKS, PRE_CHECKS, check_report, enforce
from tripfold.plans.gold import build_gold, gold_tables, silver_tables
from tripfold.plans.months import MonthResult, ingest_month, prepare_month
from tripfold.plans.pipeline import run_pipeline
from tripfold.plans.replay import evidence_log, verify_replay
from tripfold.sources.store import MonthStore


@pytest.fixture
def feed(spark, tmp_path, request):
    prefix = "feed_" + "".join(c if c.isalnum() else "_" for c in request.node.name)
    store = MonthStore(spark, FeedConfig(landing=str(tmp_path / "landing"), prefix=prefix))
    store.bootstrap()
    yield store
    for layer in ("bronze", "silver", "gold", "ops"):
        spark.sql(f"DROP SCHEMA {store.config.name(layer)} CASCADE")


def put(store, month, records, **options):
    land(store.spark, store.config.landing, month, records, **options)


def process(store, month, run_id):
    ingest_month(store, month, run_id)
    return prepare_month(store, month, run_id)


def totals(store, month):
    return tuple(
        store.table("silver", "trips", month)
        .agg(F.count("*"), F.sum("fare_amount"))
        .first()
    )


def status(store, month):
    (row,) = store.table("ops", "month_status", month).collect()
    return row


def test_a_month_is_split_and_counted(feed):
    put(feed, "2026-01", MIXED)
    assert process(feed, "2026-01", "r1") == MonthResult("2026-01", "SUCCESS", 9, 5, 4, 2)
    found = feed.table("silver", "rejected_trips", "2026-01").select("rejection_reasons").collect()
    assert Counter(reason for row in found for reason in row.rejection_reasons) == REFUSED
    assert totals(feed, "2026-01") == (5, KEPT_FARES)


def test_a_month_done_again_moves_nothing_else(feed):
    months = ["2026-01", "2026-02"]
    for month in months:
        put(feed, month, MIXED)
        process(feed, month, "r1")
    put(feed, "2026-02", CLEAN)
    for run_id in ("r2", "r3"):
        process(feed, "2026-02", run_id)
        assert [totals(feed, month) for month in months] == [(5, KEPT_FARES), (2, 35)]
        assert feed.table("silver", "rejected_trips").where("source_month > '2026-01'").isEmpty()
        build_gold(feed, months)
        assert feed.table("gold", "fct_trips").count() == 7
    assert {row.violations for row in check_report(gold_tables(feed)).collect()} == {0}


def test_bronze_rewritten_from_itself_empties_the_quarantine(feed):
    put(feed, "2026-01", MIXED)
    process(feed, "2026-01", "r1")
    sound = feed.table("bronze", "yellow_trips", "2026-01").where(
        "DOLocationID < 3 AND tpep_dropoff_datetime >= tpep_pickup_datetime"
    )
    feed.replace_month_via_staging(sound, "bronze", "yellow_trips", "2026-01")
    assert prepare_month(feed, "2026-01", "r2").rejected_count == 0
    assert feed.table("silver", "rejected_trips", "2026-01").isEmpty()
    assert totals(feed, "2026-01") == (5, KEPT_FARES)


def test_an_entirely_rejected_month_fails_and_blocks_gold(feed):
    put(feed, "2026-01", MIXED)
    put(feed, "2026-02", MIXED)
    process(feed, "2026-01", "r1")
    process(feed, "2026-02", "r1")
    build_gold(feed, ["2026-01"])

    put(feed, "2026-02", ALL_BAD)
    with pytest.raises(ValueError, match="no accepted record"):
        process(feed, "2026-02", "r2")
    assert status(feed, "2026-02").status == "FAILED"
    assert feed.table("silver", "trips", "2026-02").isEmpty()  # replaced, then refused
    with pytest.raises(ValueError, match="2026-02: not_success"):
        build_gold(feed, ["2026-01"])
    assert feed.table("gold", "fct_trips").count() == 10  # still the earlier publication

    put(feed, "2026-02", CLEAN)
    process(feed, "2026-02", "r3")
    assert build_gold(feed, ["2026-01", "2026-02"])["status"] == "SUCCESS"
    assert feed.table("gold", "fct_trips").count() == 7


@pytest.mark.parametrize(
    "zones, message",
    [
        ("1,B,A,Y\n1,B,A,Y\n", "unique"),
        ("one,B,A,Y\n", "integers"),
        ("", "empty"),
    ],
)
def test_zone_contract_stops_the_month_before_any_table(feed, zones, message):
    put(feed, "2026-01", MIXED, zones=zones)
    with pytest.raises(ValueError, match=message):
        ingest_month(feed, "2026-01", "r1")
    assert status(feed, "2026-01").status == "FAILED"
    assert not feed.exists("bronze", "yellow_trips")


def test_malformed_lookup_line_fails(feed):
    put(feed, "2026-01", MIXED, zones="1,B,A,Y\n2,B\n")
    with pytest.raises(Exception):
        ingest_month(feed, "2026-01", "r1")
    assert status(feed, "2026-01").status == "FAILED"


def test_trip_contracts(feed):
    put(feed, "2026-01", [])
    with pytest.raises(ValueError, match="no trips"):
        ingest_month(feed, "2026-01", "r1")
    with pytest.raises(ValueError):
        ingest_month(feed, "2026-13", "r1")
    with pytest.raises(ValueError, match="run id"):
        ingest_month(feed, "2026-01", "")
    events = feed.table("ops", "run_events").orderBy("event_time").collect()
    assert [(e.status, e.error_type) for e in events] == [
        ("STARTED", None),
        ("FAILED", "ValueError"),
    ]


def test_prepare_needs_raw_records(feed):
    put(feed, "2026-01", MIXED)
    ingest_month(feed, "2026-01", "r1")
    assert status(feed, "2026-01").status == "INGESTED"
    assert status(feed, "2026-01").input_count == 9
    with pytest.raises(ValueError, match="no raw records"):
        prepare_month(feed, "2026-02", "r1")
    with pytest.raises(ValueError, match="not_success"):
        build_gold(feed, ["2026-01"])


def test_pipeline_and_publication(feed):
    put(feed, "2026-01", MIXED)
    put(feed, "2026-02", CLEAN)
    result = run_pipeline(feed.spark, feed.config, ["2026-02", "2026-01"], "run-7")
    assert result["status"] == "SUCCESS" and result["run_id"] == "run-7"
    assert result["months"] == ["2026-01", "2026-02"]
    monthly = {r.pickup_month: r for r in feed.table("gold", "mart_monthly_activity").collect()}
    assert monthly["2026-02"].trip_count == 1  # calendar month, not file month
    assert monthly["2026-01"].recorded_fare_amount == 78
    assert feed.table("gold", "stg_trips").count() == 7
    services = [
        (e.source_month, e.service, e.status)
        for e in feed.table("ops", "run_events").orderBy("event_time").collect()
    ]
    assert services[0] == ("2026-01", "pipeline", "STARTED")
    assert services[-1] == ("2026-01", "pipeline", "SUCCESS")
    assert len(services) == 10
    with pytest.raises(ValueError):
        run_pipeline(feed.spark, feed.config, [], "run-8")


def test_pipeline_refuses_columns_the_dictionary_lacks(feed):
    put(feed, "2026-01", MIXED)
    path = f"{feed.config.landing}/2026-01/yellow_tripdata_2026-01.parquet"
    frame = feed.spark.read.parquet(path).withColumn("new_fee", F.lit(1.0))
    other = path.replace("landing", "widened")
    frame.write.parquet(other)
    feed.spark.read.parquet(other).write.mode("overwrite").parquet(path)
    with pytest.raises(ValueError, match="new_fee"):
        run_pipeline(feed.spark, feed.config, ["2026-01"], "run-1")
    last = feed.table("ops", "run_events").where("service = 'pipeline'").orderBy("event_time")
    assert [e.status for e in last.collect()] == ["STARTED", "FAILED"]


def test_replay_evidence(feed):
    put(feed, "2026-01", MIXED)
    put(feed, "2026-02", MIXED)
    for month in ("2026-01", "2026-02"):
        process(feed, month, "r1")
    assert verify_replay(feed, "2026-01", "replay-1")["status"] == "PASS"
    log = evidence_log(feed, "replay-1").collect()
    assert [r.stage for r in log] == ["BEFORE"] * 10 + ["AFTER"] * 10 + ["PASS"]
    snapshot = [json.loads(r.evidence_json) for r in log[:10]]
    trips = next(
        s for s in snapshot
        if s["table_name"] == "silver.trips" and s["source_month"] == "2026-01"
    )
    assert trips["row_count"] == 5 and trips["sum_fare_amount"] == KEPT_FARES
    assert list(trips) == sorted(trips)

    put(feed, "2026-01", CLEAN)  # the landing files changed in between
    with pytest.raises(AssertionError, match="silver.trips"):
        verify_replay(feed, "2026-01", "replay-2")
    assert evidence_log(feed, "replay-2").collect()[-1].stage == "FAIL"


def test_checks_catch_faults(feed):
    """Each check passes on sound tables and fails on the fault made for it."""
    from dataclasses import replace

    put(feed, "2026-01", MIXED)
    process(feed, "2026-01", "r1")
    build_gold(feed, ["2026-01"])
    sound = gold_tables(feed)
    enforce(sound, CHECKS)
    other_run = sound.status.withColumn("run_id", F.lit("r0"))
    faults = {
        "months_are_ready": replace(sound, status=sound.status.withColumn("status", F.lit(None))),
        "preparation_generation_matches": replace(sound, status=other_run),
        "gold_generation_matches": replace(sound, status=other_run),
        "rejections_have_reasons": replace(
            sound, rejected=sound.rejected.withColumn("rejection_reasons", F.array())
        ),
        "source_counts_reconcile": replace(sound, rejected=sound.rejected.limit(2)),
        "dimension_keys": replace(sound, dim=sound.dim.unionAll(sound.dim)),
        "fact_relationships": replace(sound, dim=sound.dim.where("zone_id = 1")),
        "valid_journeys": replace(
            sound, fact=sound.fact.withColumn("duration_minutes", F.lit(-1))
        ),
        "aggregate_totals_reconcile": replace(
            sound, fact=sound.fact.withColumn("fare_amount", F.col("fare_amount") + 1)
        ),
    }
    assert set(faults) == set(CHECKS) == set(PRE_CHECKS + POST_CHECKS)
    for name, tables in faults.items():
        with pytest.raises(ValueError, match=name):
            enforce(tables, [name])
    lost = replace(sound, status=sound.status.where("false"))
    for name in ("source_counts_reconcile", "preparation_generation_matches"):
        with pytest.raises(ValueError, match=name):
            enforce(lost, [name])
    enforce(silver_tables(feed), PRE_CHECKS)


def test_a_faulty_model_is_not_published(feed, monkeypatch):
    from tripfold.operators import models

    put(feed, "2026-01", rows((*GOOD, 15)))
    process(feed, "2026-01", "r1")
    build_gold(feed, ["2026-01"])
    put(feed, "2026-01", CLEAN)
    process(feed, "2026-01", "r2")
    sound = models.mart_monthly_activity
    monkeypatch.setattr(
        models, "mart_monthly_activity", lambda fact: sound(fact).withColumn("trip_count", F.lit(9))
    )
    with pytest.raises(ValueError, match="aggregate_totals_reconcile"):
        build_gold(feed, ["2026-01"])
    assert feed.table("gold", "fct_trips").count() == 1  # the earlier generation
    monkeypatch.undo()
    build_gold(feed, ["2026-01"])
    assert feed.table("gold", "fct_trips").count() == 2
