"""Typed normalisation, rejection reasons, warnings, and the accept/quarantine split."""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripfold.functions.durations import wall_minutes
from tripfold.functions.lookups import ROW, fits_broadcast, lookup_join, numbered
from tripfold.functions.months import month_of
from tripfold.functions.rules import Rule, tag
from tripfold.sources.landing import REQUIRED_TRIP_COLUMNS, require_columns

ACCEPTED = "accepted"
REJECTED = "rejected"


@dataclass(frozen=True)
class Thresholds:
    """Screening limits.  They warn; they never reject."""

    max_distance: float = 100
    max_fare: float = 500


def normalize(raw: DataFrame) -> DataFrame:
    """The seven required columns, typed and renamed, plus provenance.

    A value that cannot be cast becomes NULL and is left to the rules."""
    require_columns(raw, REQUIRED_TRIP_COLUMNS)

    def typed(source: str, data_type: str, name: str):
        return F.col(source).try_cast(data_type).alias(name)

    return raw.select(
        typed("tpep_pickup_datetime", "timestamp_ntz", "pickup_at"),
        typed("tpep_dropoff_datetime", "timestamp_ntz", "dropoff_at"),
        typed("PULocationID", "int", "pickup_zone_id"),
        typed("DOLocationID", "int", "dropoff_zone_id"),
        typed("trip_distance", "double", "trip_distance_miles"),
        typed("fare_amount", "decimal(18,2)", "fare_amount"),
        typed("total_amount", "decimal(18,2)", "total_amount"),
        "source_month",
        "source_filename",
        "ingested_at",
        "ingestion_run_id",
    )


def rejection_rules() -> list[Rule]:
    """Rules over normalised columns plus the two zone membership markers."""
    pickup, dropoff = F.col("pickup_at"), F.col("dropoff_at")
    return [
        Rule("missing_or_invalid_timestamp", pickup.isNull() | dropoff.isNull()),
        Rule("reversed_journey", dropoff < pickup),
        Rule("invalid_pickup_zone", F.col("known_pickup").isNull()),
        Rule("invalid_dropoff_zone", F.col("known_dropoff").isNull()),
    ]


def warning_rules(limits: Thresholds = Thresholds()) -> list[Rule]:
    distance, fare, total = (
        F.col("trip_distance_miles"),
        F.col("fare_amount"),
        F.col("total_amount"),
    )
    return [
        # NaN sorts above every number, so the upper limit catches it as well.
        Rule(
            "unusual_distance",
            distance.isNull() | ~((distance > 0) & (distance <= limits.max_distance)),
        ),
        Rule("unusual_fare", fare.isNull() | ~fare.between(0, limits.max_fare)),
        Rule("unusual_total", total.isNull() | (total < 0)),
        Rule("pickup_outside_source_month", month_of(F.col("pickup_at")) != F.col("source_month")),
    ]


def validate(
    raw: DataFrame,
    zones: DataFrame,
    limits: Thresholds = Thresholds(),
    small_zones: bool | None = None,
) -> DataFrame:
    """Normalise raw records and tag each with reasons, warnings and its duration.

    A zone is known when the lookup snapshot of the record's own month has it, so any
    number of months can be validated in one pass.  Row-local but for the two lookups:
    with a broadcast lookup there is no shuffle between scan and sink.  ``small_zones``
    skips measuring the lookup when the caller already has."""
    trips = normalize(raw)
    known = zones.select("source_month", "zone_id").distinct()
    if small_zones is None:
        small_zones = fits_broadcast(known)

    trips = numbered(trips, small_zones)
    for role in ("pickup", "dropoff"):
        side = known.withColumn(f"known_{role}", F.col("zone_id"))
        keys = {"source_month": "source_month", f"{role}_zone_id": "zone_id"}
        trips = lookup_join(trips, side, keys, small_zones)

    return trips.withColumns(
        {
            "rejection_reasons": tag(rejection_rules()),
            "quality_warnings": tag(warning_rules(limits)),
            "duration_minutes": wall_minutes(F.col("pickup_at"), F.col("dropoff_at")),
        }
    ).drop("known_pickup", "known_dropoff", ROW)


def with_outcome(validated: DataFrame) -> DataFrame:
    """Name each record's destination, so that one write can serve both."""
    return validated.withColumn(
        "outcome", F.when(F.size("rejection_reasons") == 0, ACCEPTED).otherwise(REJECTED)
    )


def accepted(validated: DataFrame) -> DataFrame:
    return validated.where(F.size("rejection_reasons") == 0)


def rejected(validated: DataFrame) -> DataFrame:
    return validated.where(F.size("rejection_reasons") > 0)


def split_counts(validated: DataFrame) -> DataFrame:
    """Input, accepted, rejected and unusual counts per month, in one pass.

    Warnings are counted among accepted records only."""
    passed = F.size("rejection_reasons") == 0
    return validated.groupBy("source_month").agg(
        F.count("*").alias("input_count"),
        F.count_if(passed).alias("accepted_count"),
        F.count_if(~passed).alias("rejected_count"),
        F.count_if(passed & (F.size("quality_warnings") > 0)).alias("unusual_count"),
    )
