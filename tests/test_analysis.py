"""Answers of one pinned generation."""

import pytest
from pyspark.sql import functions as F

from fixtures import CLEAN, GOOD, MIXED, rows
from test_pipeline import feed, process, put  # noqa: F401
from tripfold.plans.analysis import analyse
from tripfold.plans.gold import TABLE_MODELS, build_gold
from tripfold.sources.generations import Generations


def test_a_build_between_two_answers_mixes_nothing(feed):  # noqa: F811
    put(feed, "2026-01", MIXED)
    process(feed, "2026-01", "r1")
    build_gold(feed, ["2026-01"])
    first = analyse(feed, ["2026-01"])
    hours = first.top_zone_hours().collect()
    assert {r.warning for r in first.warning_breakdown().collect()}
    assert first.rejection_breakdown().count() == 4

    put(feed, "2026-01", rows((*GOOD, 15)))
    put(feed, "2026-02", CLEAN)
    for month in ("2026-01", "2026-02"):
        process(feed, month, "r2")
    build_gold(feed, ["2026-01", "2026-02"])
    assert first.top_zone_hours().collect() == hours
    assert sum(r.trip_count for r in first.monthly_change("2026-01", "2026-12").collect()) == 5
    assert first.slow_routes(1).agg(F.sum("trip_count")).first()[0] == 5
    with pytest.raises(Exception, match="another run of 2026-0"):
        first.warning_breakdown().collect()

    second = analyse(feed, ["2026-02"])
    assert second.generation.name != first.generation.name
    assert sum(r.completed_trips for r in second.top_zone_hours().collect()) == 3
    assert second.slow_routes(1).agg(F.sum("trip_count")).first()[0] == 3


def test_the_gate_stays_shut(feed):  # noqa: F811
    put(feed, "2026-01", CLEAN)
    process(feed, "2026-01", "r1")
    with pytest.raises(ValueError, match="not published"):
        analyse(feed, ["2026-01"])
    build_gold(feed, ["2026-01"])
    with pytest.raises(ValueError, match="2026-02: not_prepared"):
        analyse(feed, ["2026-02"])
    process(feed, "2026-01", "r2")  # prepared again, gold not yet
    with pytest.raises(ValueError, match="gold_generation_matches"):
        analyse(feed, ["2026-01"])
    build_gold(feed, ["2026-01"])
    assert analyse(feed, ["2026-01"]).top_zone_hours().count() == 1
    # A publication that stopped half-way: one name still shows the generation before.
    generations = Generations(feed)
    older = generations.load(generations.names()[0])
    view = feed.config.name("gold", TABLE_MODELS[-1])
    feed.spark.sql(
        f"CREATE OR REPLACE VIEW {view} TBLPROPERTIES ('generation' = '{older.name}') "
        f"AS SELECT * FROM {older.table_name(TABLE_MODELS[-1])}"
    )
    with pytest.raises(ValueError, match="not published"):
        analyse(feed, ["2026-01"])
