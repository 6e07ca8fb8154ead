"""Answers behind the gate: one published generation, pinned, checked and then asked."""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripfold.operators import answers
from tripfold.operators.checks import enforce
from tripfold.plans.gold import TABLE_MODELS, generation_tables, require_ready
from tripfold.sources.generations import Generation, Generations
from tripfold.sources.store import MonthStore

GATES = ("gold_generation_matches", "aggregate_totals_reconcile")


@dataclass(frozen=True)
class Analysis:
    """Questions to one generation of gold, whatever is published meanwhile.

    The generation's tables are never written again, and it stays readable until as many
    newer ones were published as are kept."""

    store: MonthStore
    generation: Generation

    def top_zone_hours(self, n: int = 20) -> DataFrame:
        return answers.top_zone_hours(self.generation.table("mart_pickup_activity"), n)

    def monthly_change(self, first: str, last: str) -> DataFrame:
        return answers.monthly_change(self.generation.table("mart_monthly_activity"), first, last)

    def slow_routes(self, min_trips: int = 100, n: int = 20) -> DataFrame:
        mart = self.generation.table("mart_route_duration")
        return answers.slow_routes(mart, min_trips, n)

    def rejection_breakdown(self) -> DataFrame:
        return answers.rejection_breakdown(self._silver("rejected_trips"))

    def warning_breakdown(self) -> DataFrame:
        return answers.warning_breakdown(self._silver("trips"))

    def _silver(self, name: str) -> DataFrame:
        """Silver records of the runs the generation was made from.

        Silver is replaced month by month and has no generations; a record of another run
        fails the answer, so it is never mixed with gold of an older one."""
        pairs = [(m, run) for m, run in self.generation.runs("fct_trips").items()]
        runs = self.store.spark.createDataFrame(pairs, "source_month string, __run string")
        same = F.col("preparation_run_id").eqNullSafe(F.col("__run"))
        moved = F.concat(F.lit("silver has another run of "), "source_month")
        fits = F.when(same, True).otherwise(F.raise_error(moved).cast("boolean"))
        records = self.store.table("silver", name)
        return records.join(F.broadcast(runs), "source_month", "left").where(fits).drop("__run")


def analyse(store: MonthStore, months: Sequence[str]) -> Analysis:
    """Pin the published generation and open it for questions, if it may be asked.

    All tracked months must be ready, the requested ones among them, every record in gold
    must come from the run its month was last prepared by, and totals must agree."""
    require_ready(store, months)
    generation = Generations(store).published(TABLE_MODELS)
    if generation is None:
        raise ValueError("gold is not published as one generation")
    enforce(generation_tables(store, generation), GATES)
    return Analysis(store, generation)
