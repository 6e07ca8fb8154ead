"""Gold build: readiness, pre-checks, models of the changed months, post-checks, publication."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripfold.functions.lookups import fits_broadcast
from tripfold.operators import models
from tripfold.operators.checks import (
    POST_CHECKS,
    PRE_CHECKS,
    Tables,
    enforce,
    fact_states,
    silver_states,
)
from tripfold.operators.contracts import readiness_violations, requested_frame
from tripfold.sources.generations import Generation, Generations
from tripfold.sources.store import MonthStore

TABLE_MODELS = (
    "dim_zones",
    "fct_trips",
    "mart_pickup_activity",
    "mart_monthly_activity",
    "mart_route_duration",
)
MODELS = ("dim_zones", "stg_trips") + TABLE_MODELS[1:]


def require_ready(store: MonthStore, months: Sequence[str]) -> None:
    status = store.table("ops", "month_status")
    blocking = readiness_violations(status, requested_frame(status, months))
    found = blocking.orderBy("source_month").collect()  # one row a month
    if found:
        listed = ", ".join(f"{row.source_month}: {row.violation}" for row in found)
        raise ValueError(f"gold is blocked by {listed}")


def silver_tables(store: MonthStore, **gold) -> Tables:
    return Tables(
        bronze=store.table("bronze", "yellow_trips"),
        trips=store.table("silver", "trips"),
        rejected=store.table("silver", "rejected_trips"),
        status=store.table("ops", "month_status"),
        **gold,
    )


def gold_tables(store: MonthStore) -> Tables:
    """The published models, ready to be checked."""
    return silver_tables(
        store,
        dim=store.table("gold", "dim_zones"),
        fact=store.table("gold", "fct_trips"),
        pickup_mart=store.table("gold", "mart_pickup_activity"),
        monthly_mart=store.table("gold", "mart_monthly_activity"),
        route_mart=store.table("gold", "mart_route_duration"),
    )


def month_runs(store: MonthStore) -> dict[str, str | None]:
    """The run of every month that is tracked or stored; None if it is not tracked."""
    status = store.table("ops", "month_status").select("source_month", "run_id").collect()
    tracked = {row.source_month: row.run_id for row in status}
    stored = {
        month
        for layer, name in (("bronze", "yellow_trips"), ("silver", "validated_trips"))
        if store.exists(layer, name)
        for month in store.months(layer, name)
    }
    return {month: tracked.get(month) for month in sorted(stored | set(tracked))}


class Build:
    """One generation in the making, and the published one it may take months from."""

    def __init__(self, store: MonthStore, generations: Generations, full: bool):
        self.store = store
        self.before = None if full else generations.published(TABLE_MODELS)
        self.generation = generations.begin()
        runs = month_runs(store)
        known = self.before.runs("fct_trips") if self.before else {}
        self.changed = {m: run for m, run in runs.items() if run is None or known.get(m) != run}
        self.kept = [month for month in runs if month not in self.changed]
        self.gone = [month for month in known if month not in runs]

    def source(self, layer: str, name: str) -> DataFrame:
        """The changed months of a source."""
        if not self.changed:
            return self.store.table(layer, name).where(F.lit(False))
        return self.store.table(layer, name, *self.changed)

    def write(self, frame: DataFrame, model: str, rebalance: bool = True) -> DataFrame:
        """The changed months of a model beside those that stay; returns the changed ones."""
        if self.before:
            self.generation.keep(self.before, model, self.kept)
        table = self.generation.write(frame, model, self.changed, rebalance)
        return table.where(F.col("source_month").isin(*self.changed))

    def monthly(self, parts: DataFrame) -> DataFrame:
        """The monthly mart: calendar months that a changed or dropped file month adds to, or
        added to, are summed anew over all parts, the others taken over."""
        whole = self.generation.table("monthly_parts")
        if not self.before:
            return models.mart_monthly_activity(whole)
        left = [*self.changed, *self.gone]
        old = self.before.table("monthly_parts").where(F.col("source_month").isin(*left))
        touched = F.broadcast(old.unionByName(parts).select("pickup_month").distinct())  # months
        same = F.col("pickup_month").eqNullSafe(F.col("touched"))
        touched = touched.withColumnRenamed("pickup_month", "touched")
        anew = models.mart_monthly_activity(whole.join(touched, same, "left_semi"))
        return self.before.table("mart_monthly_activity").join(touched, same, "left_anti").unionByName(anew)


def build_gold(store: MonthStore, months: Sequence[str], full: bool = False) -> dict:
    """Bring every model up to date with all silver months and publish them if they check out.

    A month is computed anew if its run is not the one the published models were made from;
    every other month keeps its files, and its share of the states that the checks read.
    The new generation is checked as a whole, and only then are the public names, which are
    views, pointed at it; a failed build leaves the published models as they were.  ``full``
    computes all months, as is due after a change of the models themselves."""
    require_ready(store, months)
    generations = Generations(store)
    build = Build(store, generations, full)
    generation = build.generation
    try:
        _write_models(store, build)
    except Exception:
        wanted = build.before.parts.values() if build.before else ()
        generations.discard(generation, [part.folder for part in wanted])
        raise
    generations.record(generation)
    generations.publish(generation, TABLE_MODELS)
    store.replace_view(
        "gold",
        "stg_trips",
        f"SELECT {', '.join(models.STG_SELECT)} FROM {store.config.name('silver', 'trips')}",
    )
    return {
        "status": "SUCCESS",
        "models": list(MODELS),
        "months": list(months),
        "rebuilt": sorted(build.changed),
    }


def _write_models(store: MonthStore, build: Build) -> None:
    trips = build.source("silver", "trips")
    rejected = build.source("silver", "rejected_trips")
    bronze = build.source("bronze", "yellow_trips")
    generation = build.generation
    build.write(silver_states(bronze, trips, rejected), "silver_states")
    states = generation.table("silver_states")
    known = Tables(bronze, trips, rejected, store.table("ops", "month_status"), known_states=states)
    enforce(known, PRE_CHECKS)

    dim = build.write(models.dim_zones(build.source("silver", "taxi_zones")), "dim_zones")
    # The fact keeps the month order of the silver scan, so a broadcast lookup lets it be
    # written where it is read; after a shuffle its months are gathered first.
    small = fits_broadcast(dim)
    fact = models.fct_trips(models.stg_trips(trips), dim, small)
    fact = build.write(fact, "fct_trips", rebalance=not small)
    build.write(fact_states(fact), "fact_states")
    build.write(models.mart_pickup_activity(fact), "mart_pickup_activity")
    build.write(models.mart_route_duration(fact), "mart_route_duration")
    parts = build.write(models.monthly_parts(fact), "monthly_parts")
    generation.write(build.monthly(parts), "mart_monthly_activity")
    enforce(generation_tables(store, generation), POST_CHECKS)


def generation_tables(store: MonthStore, generation: Generation) -> Tables:
    """One generation's models with the states they were checked by."""
    states = generation.table("silver_states").unionByName(generation.table("fact_states"))
    return silver_tables(
        store,
        dim=generation.table("dim_zones"),
        fact=generation.table("fct_trips"),
        pickup_mart=generation.table("mart_pickup_activity"),
        monthly_mart=generation.table("mart_monthly_activity"),
        route_mart=generation.table("mart_route_duration"),
        known_states=states,
    )
