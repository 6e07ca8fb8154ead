"""Integrity checks.  Each returns the violations it finds; no row means it passed.

What the checks need to know of records is one small state: sums by month, run and, for the
fact, by pair of zone keys.  Every source is aggregated once for all checks, and states add
up, so those of months that did not change can be kept."""

from collections.abc import Callable, Iterable
from dataclasses import dataclass, replace
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripfold.session import stage

RAW, ACCEPTED, REJECTED, FACT = "raw", "accepted", "rejected", "fact"
STATE_KEYS = (
    "kind",
    "source_month",
    "preparation_run_id",
    "pickup_zone_key",
    "dropoff_zone_key",
)


def _state(frame: DataFrame, kind: str, keys: tuple[str, ...], fare: Column, flaw: Column) -> DataFrame:
    sums = frame.groupBy(*keys).agg(
        F.count("*").alias("records"),
        F.sum(fare.cast("decimal(28,2)")).cast("decimal(38,2)").alias("fares"),
        F.count_if(flaw).alias("flawed"),
    )
    text = F.lit(None).cast("string")
    own = [F.col(k) if k in keys else text.alias(k) for k in STATE_KEYS[1:]]
    return sums.select(F.lit(kind).alias("kind"), *own, "records", "fares", "flawed")


def silver_states(bronze: DataFrame, trips: DataFrame, rejected: DataFrame) -> DataFrame:
    """Raw, accepted and rejected records; a rejected one without reasons is flawed."""
    none, sound = F.lit(None), F.lit(False)
    reasons = F.col("rejection_reasons")
    month = ("source_month",)
    return reduce(
        DataFrame.unionByName,
        [
            _state(bronze, RAW, month, none, sound),
            _state(trips, ACCEPTED, (*month, "preparation_run_id"), F.col("fare_amount"), sound),
            _state(rejected, REJECTED, month, none, reasons.isNull() | (F.size(reasons) == 0)),
        ],
    )


def fact_states(fact: DataFrame) -> DataFrame:
    """Fact records by run and pair of zone keys; an impossible journey is flawed."""
    return _state(fact, FACT, STATE_KEYS[1:], F.col("fare_amount"), _impossible())


def merged(states: DataFrame) -> DataFrame:
    """States of parts of the sources as the states of the whole."""
    return states.groupBy(*STATE_KEYS).agg(
        *[F.sum(c).alias(c) for c in ("records", "fares", "flawed")]
    )


@dataclass(frozen=True)
class Tables:
    """The frames the checks read.  Gold frames may be left out before gold exists, and the
    states may be given, when they are known already."""

    bronze: DataFrame
    trips: DataFrame
    rejected: DataFrame
    status: DataFrame
    dim: DataFrame | None = None
    fact: DataFrame | None = None
    pickup_mart: DataFrame | None = None
    monthly_mart: DataFrame | None = None
    route_mart: DataFrame | None = None
    known_states: DataFrame | None = None

    @cached_property
    def states(self) -> DataFrame:
        if self.known_states is not None:
            return self.known_states
        states = silver_states(self.bronze, self.trips, self.rejected)
        return states if self.fact is None else states.unionByName(fact_states(self.fact))

    def state(self, *kinds: str) -> DataFrame:
        return self.states.where(F.col("kind").isin(*kinds))


def months_are_ready(t: Tables) -> DataFrame:
    """Tracked months whose status is anything but SUCCESS, NULL included."""
    return t.status.where(~F.col("status").eqNullSafe(F.lit("SUCCESS")))


def _generation_mismatch(t: Tables, kind: str) -> DataFrame:
    """Months holding a record whose preparation run is not the one in the status."""
    run = F.col("preparation_run_id")
    known = t.status.select("source_month", "run_id")
    return (
        t.state(kind)
        .join(known, "source_month", "left")
        .where(~run.eqNullSafe(F.col("run_id")))
        .select("source_month")
        .distinct()
    )


def preparation_generation_matches(t: Tables) -> DataFrame:
    return _generation_mismatch(t, ACCEPTED)


def gold_generation_matches(t: Tables) -> DataFrame:
    return _generation_mismatch(t, FACT)


def rejections_have_reasons(t: Tables) -> DataFrame:
    reasons = F.col("rejection_reasons")
    return t.rejected.where(reasons.isNull() | (F.size(reasons) == 0))


def source_counts_reconcile(t: Tables) -> DataFrame:
    """Months where raw, accepted, rejected and status counts do not all agree.

    Sources and status are rows of one frame, so a month that any of them has is judged,
    and one aggregate by month does it without a join."""
    told = F.struct("status", "input_count", "accepted_count", "rejected_count")
    nothing = t.status.limit(0).select(told.alias("told")).schema["told"].dataType
    counted = t.state(RAW, ACCEPTED, REJECTED).select(
        "source_month", "kind", "records", F.lit(None).cast(nothing).alias("told")
    )
    stated = t.status.select(
        "source_month",
        F.lit("status").alias("kind"),
        F.lit(1).cast("bigint").alias("records"),
        told.alias("told"),
    )

    def of(kind: str) -> Column:
        return F.sum(F.when(F.col("kind") == kind, F.col("records")))

    months = counted.unionByName(stated).groupBy("source_month").agg(
        of(RAW).alias("raw"),
        F.coalesce(of(ACCEPTED), F.lit(0)).alias("kept"),
        F.coalesce(of(REJECTED), F.lit(0)).alias("refused"),
        F.max("told").alias("told"),
        (F.max("told") == F.min("told")).alias("told_once"),
    )
    agrees = (
        F.col("source_month").isNotNull()
        & F.col("told_once")
        # A NULL status is left to months_are_ready, as a NULL comparison selects nothing.
        & F.coalesce(F.col("told.status") == "SUCCESS", F.lit(True))
        & (F.col("raw") == F.col("kept") + F.col("refused"))
        & F.col("told.input_count").eqNullSafe(F.col("raw"))
        & F.col("told.accepted_count").eqNullSafe(F.col("kept"))
        & F.col("told.rejected_count").eqNullSafe(F.col("refused"))
    )
    return months.where(~F.coalesce(agrees, F.lit(False))).select("source_month")


def dimension_keys(t: Tables) -> DataFrame:
    """Zone keys that are NULL or not unique."""
    return (
        t.dim.groupBy("zone_key")
        .agg(F.count("*").alias("copies"))
        .where(F.col("zone_key").isNull() | (F.col("copies") != 1))
        .select("zone_key")
    )


def fact_relationships(t: Tables) -> DataFrame:
    """Key pairs of fact records that lack a dimension row on either side.

    Records are counted per key pair before any join, so a hot zone costs one row."""
    known = t.dim.select("zone_key").distinct()
    keys = ("pickup_zone_key", "dropoff_zone_key")
    pairs = t.state(FACT).groupBy(*keys).agg(F.sum("records").alias("trip_rows"))
    for role in ("pickup", "dropoff"):
        side = known.select(
            F.col("zone_key").alias("dim_key"), F.lit(True).alias(f"{role}_known")
        )
        pairs = pairs.join(side, F.col(f"{role}_zone_key") == F.col("dim_key"), "left").drop(
            "dim_key"
        )
    return pairs.where(F.col("pickup_known").isNull() | F.col("dropoff_known").isNull()).select(
        *keys, "trip_rows"
    )


def _impossible() -> Column:
    return F.coalesce(
        F.col("pickup_at").isNull()
        | F.col("dropoff_at").isNull()
        | (F.col("duration_minutes") < 0)
        | (F.size("rejection_reasons") != 0),
        F.lit(False),
    )


def valid_journeys(t: Tables) -> DataFrame:
    return t.fact.where(_impossible())


def aggregate_totals_reconcile(t: Tables) -> DataFrame:
    """Models whose record count or fare total differs from the accepted records.

    The route mart carries no fare, so its fare is taken as expected."""

    def totals(frame: DataFrame, model: str, trips: str, fares: Column) -> DataFrame:
        return frame.agg(
            F.coalesce(F.sum(trips), F.lit(0)).alias("trips"),
            F.coalesce(F.sum(fares), F.lit(0)).cast("decimal(38,2)").alias("fares"),
        ).select(F.lit(model).alias("model"), "trips", "fares")

    recorded = F.col("recorded_fare_amount")
    expected = totals(t.state(ACCEPTED), "silver", "records", F.col("fares"))
    actual = reduce(
        DataFrame.unionByName,
        [
            totals(t.state(FACT), "fact", "records", F.col("fares")),
            totals(t.pickup_mart, "pickup", "trip_count", recorded),
            totals(t.monthly_mart, "monthly", "trip_count", recorded),
            totals(t.route_mart, "route", "trip_count", F.lit(None)),
        ],
    )
    wanted = F.broadcast(
        expected.select(F.col("trips").alias("wanted_trips"), F.col("fares").alias("wanted_fares"))
    )
    carried = F.when(F.col("model") == "route", F.col("wanted_fares")).otherwise(F.col("fares"))
    return (
        actual.crossJoin(wanted)  # one row
        .withColumn("fares", carried)
        .where((F.col("trips") != F.col("wanted_trips")) | (F.col("fares") != F.col("wanted_fares")))
        .select("model", "trips", "fares")
    )


CHECKS: dict[str, Callable[[Tables], DataFrame]] = {
    check.__name__: check
    for check in (
        months_are_ready,
        preparation_generation_matches,
        rejections_have_reasons,
        source_counts_reconcile,
        dimension_keys,
        fact_relationships,
        gold_generation_matches,
        valid_journeys,
        aggregate_totals_reconcile,
    )
}
PRE_CHECKS = tuple(CHECKS)[:4]
POST_CHECKS = tuple(CHECKS)[4:]


#: Checks whose violations are records: the state has their number.
FLAWS = {"rejections_have_reasons": REJECTED, "valid_journeys": FACT}


def check_report(tables: Tables, names: Iterable[str] = tuple(CHECKS)) -> DataFrame:
    """Number of violations per check, all checks in one job over one stored state."""
    if tables.known_states is None:
        tables = replace(tables, known_states=stage(tables.states, "check-states"))

    def violations(name: str) -> DataFrame:
        if name in FLAWS:
            flawed = F.coalesce(F.sum("flawed"), F.lit(0))
            counted = tables.state(FLAWS[name]).agg(flawed.alias("violations"))
        else:
            counted = CHECKS[name](tables).agg(F.count("*").alias("violations"))
        return counted.select(F.lit(name).alias("check_name"), "violations")

    return reduce(DataFrame.unionByName, map(violations, names))


def enforce(tables: Tables, names: Iterable[str]) -> None:
    """Raise on the first failed check.  Only the one-row-per-check report is collected."""
    violations = {row.check_name: row.violations for row in check_report(tables, names).collect()}
    failed = [name for name in names if violations[name]]
    if failed:
        raise ValueError(
            "failed checks: " + ", ".join(f"{name} ({violations[name]})" for name in failed)
        )
