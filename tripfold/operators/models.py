"""Star schema and marts."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripfold.functions.lookups import ROW, fits_broadcast, lookup_join, numbered


# Computed columns of the staging model, in SQL so that a persistent view can use them.
# The month goes through DATE: formatting a timestamp would involve the session zone.
STG_COLUMNS = {
    "pickup_zone_key": "concat(source_month, ':', cast(pickup_zone_id AS string))",
    "dropoff_zone_key": "concat(source_month, ':', cast(dropoff_zone_id AS string))",
    "pickup_date": "cast(pickup_at AS date)",
    "pickup_month": "date_format(cast(pickup_at AS date), 'yyyy-MM')",
    "pickup_hour": "hour(pickup_at)",
    "has_quality_warning": "size(quality_warnings) > 0",
}
STG_SELECT = ["*", *[f"{expression} AS {name}" for name, expression in STG_COLUMNS.items()]]


def dim_zones(zones: DataFrame) -> DataFrame:
    """Zones with a ``YYYY-MM:id`` key, NULL as soon as either part is NULL."""
    return zones.select(
        F.concat("source_month", F.lit(":"), F.col("zone_id").cast("string")).alias("zone_key"),
        "source_month",
        "zone_id",
        "borough",
        "zone_name",
        "service_zone",
    )


def stg_trips(trips: DataFrame) -> DataFrame:
    """Accepted records plus zone keys, calendar columns and a warning flag."""
    return trips.selectExpr(*STG_SELECT)


def fct_trips(stg: DataFrame, dim: DataFrame, small_dim: bool | None = None) -> DataFrame:
    """Accepted records with zone names and boroughs for both ends.

    Left joins: an unknown key keeps its record, and the relationship check reports it."""
    attributes = dim.select("zone_key", "zone_name", "borough")
    if small_dim is None:
        small_dim = fits_broadcast(attributes)
    fact = numbered(stg, small_dim)
    for role in ("pickup", "dropoff"):
        side = attributes.select(
            "zone_key",
            F.col("zone_name").alias(f"{role}_zone_name"),
            F.col("borough").alias(f"{role}_borough"),
        )
        fact = lookup_join(fact, side, {f"{role}_zone_key": "zone_key"}, small_dim)
    return fact.drop(ROW)


def _recorded(amount: str) -> Column:
    """Sum of an amount, warned records included; no amount at all sums to 0."""
    return F.coalesce(F.sum(amount), F.lit(0).cast("decimal(28,2)"))


def _unusual() -> Column:
    return F.count_if("has_quality_warning")


def mart_pickup_activity(fact: DataFrame) -> DataFrame:
    """File month x pickup zone x hour.  Grouped by name as well as id, as published."""
    return fact.groupBy("source_month", "pickup_zone_id", "pickup_zone_name", "pickup_hour").agg(
        F.count("*").alias("trip_count"),
        _recorded("fare_amount").alias("recorded_fare_amount"),
        _unusual().alias("unusual_trip_count"),
    )


def monthly_parts(fact: DataFrame) -> DataFrame:
    """What each file month adds to each calendar month of pickup."""
    return fact.groupBy("source_month", "pickup_month").agg(
        F.count("*").alias("trip_count"),
        _recorded("fare_amount").alias("recorded_fare_amount"),
        _recorded("total_amount").alias("recorded_total_amount"),
        F.count_if(F.col("fare_amount").isNull()).alias("missing_fare_count"),
        _unusual().alias("unusual_trip_count"),
    )


def mart_monthly_activity(source: DataFrame) -> DataFrame:
    """Calendar month of pickup, whichever file the record came in; from the fact, or from
    monthly parts of it."""
    parts = source if "trip_count" in source.columns else monthly_parts(source)
    money = ("recorded_fare_amount", "recorded_total_amount")
    return parts.groupBy("pickup_month").agg(
        F.sum("trip_count").alias("trip_count"),
        *[F.sum(name).cast("decimal(28,2)").alias(name) for name in money],
        F.sum("missing_fare_count").alias("missing_fare_count"),
        F.sum("unusual_trip_count").alias("unusual_trip_count"),
    )


def mart_route_duration(fact: DataFrame) -> DataFrame:
    """File month x route, with the exact lower median of the durations.

    Records are first counted by route and duration, map-side and spread over all tasks, so
    a hot route reaches one task as at most one row for each duration it has.  Running counts
    over these rows give the median; no sketch is kept and no record is sorted."""
    route = (
        "source_month",
        "pickup_zone_id",
        "dropoff_zone_id",
        "pickup_zone_name",
        "dropoff_zone_name",
    )
    duration, n = F.col("duration_minutes"), F.col("n")
    histogram = fact.groupBy(*route, "duration_minutes").agg(
        F.count("*").alias("n"), _unusual().alias("unusual")
    )
    known = F.when(duration.isNotNull(), n)
    of_route = Window.partitionBy(*route)
    counted = histogram.select(
        "*",
        F.sum(known).over(of_route.orderBy("duration_minutes")).alias("up_to"),
        F.sum(known).over(of_route).alias("known"),
    )
    # The middle of 2k or 2k - 1 durations is the k-th.
    middle = F.when(2 * F.col("up_to") >= F.col("known"), duration)
    total = F.sum(duration * n.cast("decimal(19,0)")).cast("decimal(27,6)")
    return counted.groupBy(*route).agg(
        F.sum(n).alias("trip_count"),
        F.round(total / F.sum(known), 10).cast("decimal(31,10)").alias("average_duration_minutes"),
        F.min(middle).alias("median_duration_minutes"),
        F.sum("unusual").alias("unusual_trip_count"),
    )
