"""Questions answered from the marts and the silver tables."""

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def gated(answer: DataFrame, gates: Mapping[str, DataFrame]) -> DataFrame:
    """The answer, if none of the gates has a row; else its plan fails and names those that do.

    The gates are part of the answer's plan, so they judge the very tables it reads."""
    counts = [
        frame.agg(F.count("*").alias("violations")).select(F.lit(name).alias("gate"), "violations")
        for name, frame in gates.items()
    ]
    broken = (
        reduce(DataFrame.unionByName, counts)
        .where(F.col("violations") > 0)
        .agg(F.array_sort(F.collect_list("gate")).alias("__broken"))  # a name for each gate
    )
    blocked = F.concat(F.lit("answers are blocked by "), F.array_join("__broken", ", "))
    is_open = F.when(F.size("__broken") == 0, True).otherwise(
        F.raise_error(blocked).cast("boolean")
    )
    return answer.crossJoin(F.broadcast(broken)).where(is_open).drop("__broken")


def top_zone_hours(pickup_mart: DataFrame, n: int = 20) -> DataFrame:
    """Zone-hours with the most accepted records over all months; ties go by key."""
    keys = ("pickup_zone_id", "pickup_zone_name", "pickup_hour")
    return (
        pickup_mart.groupBy(*keys)
        .agg(F.sum("trip_count").alias("completed_trips"))
        .orderBy(F.desc("completed_trips"), *keys)
        .limit(n)
    )


def monthly_change(monthly_mart: DataFrame, first: str, last: str) -> DataFrame:
    """Change in records against the previous month present in the range.

    The window is unpartitioned on purpose: the mart has one row per calendar month."""
    previous = F.lag("trip_count").over(Window.orderBy("pickup_month"))
    return (
        monthly_mart.where(F.col("pickup_month").between(first, last))
        .withColumn("trip_count_change", F.col("trip_count") - previous)
        .orderBy("pickup_month")
    )


def slow_routes(route_mart: DataFrame, min_trips: int = 100, n: int = 20) -> DataFrame:
    """Routes with the longest median among those with enough records; ties go by key."""
    return (
        route_mart.where(F.col("trip_count") >= min_trips)
        .orderBy(
            F.desc("median_duration_minutes"),
            "source_month",
            "pickup_zone_id",
            "dropoff_zone_id",
            "pickup_zone_name",
            "dropoff_zone_name",
        )
        .limit(n)
    )


def code_breakdown(frame: DataFrame, codes: str, code: str, count: str) -> DataFrame:
    """Records per month and code; a record counts once for each code it carries.

    The outer generator keeps records without a code for the filter to drop.  A plain
    one makes the optimizer test the size of the list beforehand, which evaluates the
    rules a second time where the list is not stored yet."""
    return (
        frame.select("source_month", F.explode_outer(codes).alias(code))
        .where(F.col(code).isNotNull())
        .groupBy("source_month", code)
        .agg(F.count("*").alias(count))
        .orderBy("source_month", F.desc(count), code)
    )


def rejection_breakdown(rejected: DataFrame) -> DataFrame:
    return code_breakdown(rejected, "rejection_reasons", "reason", "rejected_records_with_reason")


def warning_breakdown(accepted: DataFrame) -> DataFrame:
    return code_breakdown(accepted, "quality_warnings", "warning", "accepted_records_with_warning")


def status_pct(status: DataFrame) -> DataFrame:
    """Rejected and warned shares per month; NULL where the base is zero."""
    return status.withColumns(
        {
            "rejected_pct": F.try_divide(
                100 * F.col("rejected_count"), F.col("input_count")
            ),
            "accepted_warning_pct": F.try_divide(
                100 * F.col("unusual_count"), F.col("accepted_count")
            ),
        }
    ).orderBy("source_month")


def status_reconciled(status: DataFrame) -> DataFrame:
    return status.withColumn(
        "reconciled",
        F.col("input_count") == F.col("accepted_count") + F.col("rejected_count"),
    )


def sensitivity(accepted: DataFrame, long_minutes: int = 180) -> DataFrame:
    """How much fare warnings and extreme durations weigh, per month."""
    duration = F.col("duration_minutes")
    warned = F.array_contains("quality_warnings", "unusual_fare")
    return accepted.groupBy("source_month").agg(
        F.count("*").alias("accepted"),
        F.sum("fare_amount").alias("fare_all"),
        F.sum(F.when(~warned, F.col("fare_amount"))).alias("fare_without_fare_warning"),
        F.count_if(duration == 0).alias("zero_duration"),
        F.count_if(duration > long_minutes).alias(f"over_{long_minutes}_minutes"),
        F.percentile_approx(duration, [0.5, 0.95, 0.99]).alias("duration_percentiles"),
    )
