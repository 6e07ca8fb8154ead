"""Gold by generations: what an increment writes, reads and leaves, and that it equals a
full build."""

import io
import os
from collections import Counter
from contextlib import redirect_stdout
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fixtures import CLEAN, GOOD, MIXED, rows
from test_pipeline import feed, process, put  # noqa: F401
from tripfold.operators import checks, models
from tripfold.plans.gold import TABLE_MODELS, build_gold, gold_tables
from tripfold.sources.generations import KEPT, Generations

LATE = rows(
    ("2026-01-31 23:50:00", "2026-02-01 00:10:00", 1, 2, 2.0, 9),  # of January, in March's file
    ("2026-03-05 10:00:00", "2026-03-05 10:07:00", 2, 1, 2.0, 8),
    ("2026-03-05 10:00:00", "2026-03-05 10:09:00", 2, 1, 2.0, None),
)


def shown(store):
    return {
        model: Counter(str(r) for r in store.table("gold", model).select(*sorted(
            c for c in store.table("gold", model).columns if not c.endswith("ed_at")
        )).collect())
        for model in TABLE_MODELS
    }


def files(store, *months):
    """Paths and times of the files that the public gold names read for some months."""
    found = {}
    for model in TABLE_MODELS:
        frame = store.table("gold", model)
        if "source_month" not in frame.columns:
            continue
        for path in frame.where(F.col("source_month").isin(*months)).inputFiles():
            found[path] = os.path.getmtime(path.removeprefix("file://"))
    return found


def test_one_more_month_rewrites_none_and_equals_a_full_build(feed):  # noqa: F811
    for month, records in (("2026-01", MIXED), ("2026-02", CLEAN)):
        put(feed, month, records)
        process(feed, month, "r1")
    assert build_gold(feed, ["2026-01"])["rebuilt"] == ["2026-01", "2026-02"]
    before = files(feed, "2026-01", "2026-02")
    assert len(before) >= 8

    put(feed, "2026-03", LATE)
    process(feed, "2026-03", "r2")
    assert build_gold(feed, ["2026-03"])["rebuilt"] == ["2026-03"]
    assert files(feed, "2026-01", "2026-02") == before
    grown = shown(feed)
    monthly = {r.pickup_month: r for r in feed.table("gold", "mart_monthly_activity").collect()}
    assert monthly["2026-01"].trip_count == 7 and monthly["2026-03"].missing_fare_count == 1

    assert build_gold(feed, ["2026-03"])["rebuilt"] == []  # nothing new
    assert shown(feed) == grown and files(feed, "2026-01", "2026-02") == before
    assert len(build_gold(feed, ["2026-03"], full=True)["rebuilt"]) == 3
    assert shown(feed) == grown
    assert not set(files(feed, "2026-01")) & set(before)


def test_a_month_done_again_leaves_no_trace_of_its_old_self(feed):  # noqa: F811
    put(feed, "2026-01", CLEAN)
    put(feed, "2026-03", LATE)
    for month in ("2026-01", "2026-03"):
        process(feed, month, "r1")
    build_gold(feed, ["2026-01"])
    kept = files(feed, "2026-01")
    put(feed, "2026-03", rows(("2026-04-01 10:00:00", "2026-04-01 10:09:00", 1, 1, 2.0, 4)))
    process(feed, "2026-03", "r2")
    assert build_gold(feed, ["2026-01"])["rebuilt"] == ["2026-03"]
    monthly = {
        r.pickup_month: (r.trip_count, r.recorded_fare_amount)
        for r in feed.table("gold", "mart_monthly_activity").collect()
    }
    assert monthly == {"2026-01": (2, 35), "2026-04": (1, 4)}  # no March any more
    assert files(feed, "2026-01") == kept
    once = shown(feed)
    build_gold(feed, ["2026-01"], full=True)
    assert shown(feed) == once


def test_a_month_no_longer_tracked_leaves_gold(feed):  # noqa: F811
    for month in ("2026-01", "2026-02"):
        put(feed, month, CLEAN)
        process(feed, month, "r1")
    build_gold(feed, ["2026-01"])
    spark = feed.spark
    for layer, name in (
        ("ops", "month_status"),
        ("bronze", "yellow_trips"),
        ("bronze", "taxi_zones"),
        ("silver", "taxi_zones"),
    ):
        spark.sql(
            f"ALTER TABLE {feed.config.name(layer, name)} DROP PARTITION (source_month='2026-02')"
        )
    trips = feed.config.name("silver", "validated_trips")
    spark.sql(f"ALTER TABLE {trips} DROP PARTITION (source_month='2026-02', outcome='accepted')")
    assert build_gold(feed, ["2026-01"])["rebuilt"] == []
    assert feed.table("gold", "fct_trips").count() == 2
    assert feed.table("gold", "mart_monthly_activity").first().trip_count == 2


def test_records_of_an_untracked_month_block_gold(feed):  # noqa: F811
    put(feed, "2026-01", CLEAN)
    process(feed, "2026-01", "r1")
    build_gold(feed, ["2026-01"])
    stray = feed.table("bronze", "yellow_trips").withColumn("source_month", F.lit("2026-09"))
    feed.replace_month(stray, "bronze", "yellow_trips", "2026-09")
    with pytest.raises(ValueError, match="source_counts_reconcile"):
        build_gold(feed, ["2026-01"])


def test_failed_and_old_generations_leave_no_files(feed, monkeypatch):  # noqa: F811
    put(feed, "2026-01", CLEAN)
    process(feed, "2026-01", "r1")
    build_gold(feed, ["2026-01"])
    generations = Generations(feed)
    (first,) = generations.names()
    database = feed.spark.catalog.getDatabase(feed.config.name("gold")).locationUri

    def stored():
        folder = f"{database.removeprefix('file:')}/fct_trips__parts"
        return sum(name.endswith(".parquet") for _, _, names in os.walk(folder) for name in names)

    held = stored()
    sound = models.mart_route_duration
    monkeypatch.setattr(models, "mart_route_duration", lambda fact: sound(fact).limit(0))
    with pytest.raises(ValueError, match="aggregate_totals"):
        build_gold(feed, ["2026-01"], full=True)
    monkeypatch.undo()
    assert generations.names() == [first] and stored() == held
    for number in range(KEPT + 1):
        build_gold(feed, ["2026-01"], full=True)
        assert len(generations.names()) == min(KEPT, number + 2)
    assert first not in generations.names()
    assert feed.table("gold", "fct_trips").count() == 2 and stored() <= KEPT * held
    tables = [r.tableName for r in feed.spark.sql(f"SHOW TABLES IN {feed.config.name('gold')}").collect()]
    assert not any(first in name for name in tables)


def explained(frame):
    with redirect_stdout(io.StringIO()) as told:
        frame.explain("formatted")
    return told.getvalue()


def test_a_report_reads_records_once_a_source(feed):  # noqa: F811
    put(feed, "2026-01", MIXED)
    process(feed, "2026-01", "r1")
    build_gold(feed, ["2026-01"])
    known = gold_tables(feed)
    tables = checks.Tables(**{**known.__dict__, "known_states": None})
    plan = explained(tables.states)
    scans = [line for line in plan.splitlines() if line.startswith("Location: ")]
    assert len(scans) == 4  # bronze, accepted, rejected, fact
    report = checks.check_report(tables)
    assert {r.check_name: r.violations for r in report.collect()} == dict.fromkeys(checks.CHECKS, 0)
    read = [line for line in explained(report).splitlines() if line.startswith("Location: ")]
    assert not any(name in line for line in read for name in ("yellow_trips", "validated", "fct_"))


def test_states_of_parts_add_up(spark):
    rows_ = [("a", 1, "x", "y", "1.50"), ("a", 2, "x", "y", None), ("b", 3, None, "y", "2.25")]
    fact = spark.createDataFrame(
        [(m, "r", p, d, None if f is None else Decimal(f)) for m, _, p, d, f in rows_] * 2,
        "source_month string, preparation_run_id string, pickup_zone_key string, "
        "dropoff_zone_key string, fare_amount decimal(18,2)",
    ).selectExpr(
        "*",
        "timestamp_ntz '2026-01-01 00:00:00' pickup_at",
        "timestamp_ntz '2026-01-01 00:00:00' dropoff_at",
        "if(source_month = 'b', -1, 1) duration_minutes",
        "array() rejection_reasons",
    )
    whole = Counter(map(tuple, checks.fact_states(fact).collect()))
    halves = [checks.fact_states(part) for part in fact.randomSplit([1.0, 1.0], 4)]
    assert Counter(map(tuple, checks.merged(halves[0].unionByName(halves[1])).collect())) == whole
    assert sum(row[5] for row in whole) == 6 and sum(row[7] for row in whole) == 2


def test_a_median_is_exact_on_a_hot_route(spark):
    """A million records of one route beside small ones; the middle is known by rule."""
    number = 1_000_000
    fact = spark.range(number + 7, numPartitions=8).selectExpr(
        "'2026-01' source_month",
        f"if(id < {number}, 1, id) pickup_zone_id",
        "2 dropoff_zone_id",
        "cast(null as string) pickup_zone_name",
        "'B' dropoff_zone_name",
        # 0, 1/60, ... 5999/60 minutes, the later ones rarer; unknown for the last routes.
        f"cast(if(id < {number}, floor(pow(id % 1000, 2) / 1000) * 6 + id % 6, "
        f"if(id % 2 = 0, 7, null)) / 60.0 as decimal(27,6)) duration_minutes",
        "id % 10 = 0 has_quality_warning",
    )
    found = {r.pickup_zone_id: r for r in models.mart_route_duration(fact).collect()}
    assert len(found) == 8
    hot = found[1]
    durations = sorted(
        r.duration_minutes for r in fact.where("pickup_zone_id = 1").select("duration_minutes").toLocalIterator()
    )
    assert hot.trip_count == number and hot.unusual_trip_count == number // 10
    assert hot.median_duration_minutes == durations[number // 2 - 1]
    mean = sum(durations) / number
    assert abs(hot.average_duration_minutes - mean) <= Decimal("0.00000000005")
    assert found[number].median_duration_minutes == Decimal("0.116667")
    alone = found[number + 1]
    assert (alone.trip_count, alone.median_duration_minutes, alone.average_duration_minutes) == (1, None, None)
    plan = explained(models.mart_route_duration(fact))
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan
