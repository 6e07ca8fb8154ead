"""Named queries over the order tables, read as a monthly journey feed.

Each query works on whole tables.  ``comparable`` turns the types that engines print
differently into plain ones, decimals into text with all their digits; the operators
themselves return their own types."""

import uuid
from dataclasses import replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DateType,
    DecimalType,
    IntegerType,
    TimestampNTZType,
)

from tripfold.config import FeedConfig
from tripfold.functions.lookups import fits_broadcast
from tripfold.functions.months import month_contract
from tripfold.operators import answers, checks, contracts, models, profile, snapshot, validate
from tripfold.plans.gold import build_gold
from tripfold.plans.months import prepare_month
from tripfold.session import stage
from tripfold.sources import orders_feed
from tripfold.sources.store import MonthStore

RUN_ID = "run-1"
OTHER_RUN_ID = "run-0"
FIRST_MONTH, LAST_MONTH = "1995-01", "1995-12"
MIN_ROUTE_TRIPS = 5
CATEGORIES = (
    "l_returnflag",
    "l_linestatus",
    "o_orderstatus",
    "c_mktsegment",
    "Borough",
    "service_zone",
)
#: A sketch with a relative deviation of 0.05 is all but always within this share.
SKETCH_ERROR = 0.25
REQUESTED_MONTHS = ("1995-01", "1996-02", "2031-01")

# Where the check queries plant their faults.
FAILED_MONTH = "1996-02"
UNSTATED_MONTH = "1996-03"
STALE_MONTH = "1997-05"
MISCOUNTED_MONTH = "1998-07"
UNTRACKED_MONTH = "1999-09"
BLANKED_MONTH = "1996-06"
SHIFTED_MONTH = "1996-04"
REPEATED_ZONE = "1995-03:3"
MISSING_ZONE = "1995-04:7"
ZONELESS_MONTH = "1997-02"
ODD_MONTH = "1997-03"
BLANK_MONTH = "1997-04"
TWICE_MONTH = "1997-06"
INCREMENT_MONTHS = ("1995-01", "1995-02", "1995-03")


def comparable(frame: DataFrame) -> DataFrame:
    columns = []
    for field in frame.schema.fields:
        column, kind = F.col(field.name), field.dataType
        if isinstance(kind, DecimalType):
            column = column.cast("string")  # scale and all
        elif isinstance(kind, IntegerType):
            column = column.cast("bigint")
        elif isinstance(kind, (TimestampNTZType, DateType)):
            column = column.cast("string")
        elif isinstance(kind, ArrayType):
            if isinstance(kind.elementType, DecimalType):
                # Percentiles come without trailing zeros; a wider type has them again.
                digits, scale = kind.elementType.precision, kind.elementType.scale
                column = column.cast(f"array<decimal({digits + 1},{scale})>")
            column = F.array_join(column.cast("array<string>"), "|")
        columns.append(column.alias(field.name))
    return frame.select(*columns)


class Feed:
    """Every layer of the feed as lazy frames; nothing is computed until it is used."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    @cached_property
    def bronze(self) -> DataFrame:
        return orders_feed.raw_trips(self.spark, self.folder)

    @cached_property
    def zones(self) -> DataFrame:
        return orders_feed.places(self.spark, self.folder)

    @cached_property
    def raw_zones(self) -> DataFrame:
        return orders_feed.raw_places(self.spark, self.folder)

    @cached_property
    def small_zones(self) -> bool:
        return fits_broadcast(self.zones)

    @cached_property
    def validated(self) -> DataFrame:
        return validate.validate(
            self.bronze, self.zones, small_zones=self.small_zones
        ).withColumn("preparation_run_id", F.lit(RUN_ID))

    @cached_property
    def trips(self) -> DataFrame:
        return validate.accepted(self.validated)

    @cached_property
    def rejected(self) -> DataFrame:
        return validate.rejected(self.validated)

    @cached_property
    def counts(self) -> DataFrame:
        return validate.split_counts(self.validated)

    @cached_property
    def status(self) -> DataFrame:
        return self.counts.select(
            "source_month",
            F.lit(RUN_ID).alias("run_id"),
            F.lit("SUCCESS").alias("status"),
            "input_count",
            "accepted_count",
            "rejected_count",
            "unusual_count",
        )

    @cached_property
    def dim(self) -> DataFrame:
        return models.dim_zones(self.zones)

    @cached_property
    def stg(self) -> DataFrame:
        return models.stg_trips(self.trips)

    @cached_property
    def fact(self) -> DataFrame:
        return models.fct_trips(self.stg, self.dim, self.small_zones)

    @cached_property
    def pickup_mart(self) -> DataFrame:
        return models.mart_pickup_activity(self.fact)

    @cached_property
    def monthly_mart(self) -> DataFrame:
        return models.mart_monthly_activity(self.fact)

    @cached_property
    def route_mart(self) -> DataFrame:
        return models.mart_route_duration(self.fact)

    @cached_property
    def lookups(self) -> dict[str, DataFrame]:
        return {
            "bronze.yellow_trips": self.bronze,
            "bronze.taxi_zones": self.zones,
            "silver.taxi_zones": self.zones,
        }

    @cached_property
    def sources(self) -> dict[str, DataFrame]:
        return {"bronze.yellow_trips": self.bronze, "bronze.taxi_zones": self.raw_zones}

    @cached_property
    def layers(self) -> dict[str, DataFrame]:
        return {
            **self.sources,
            "silver.trips": self.trips,
            "silver.rejected_trips": self.rejected,
            "silver.taxi_zones": self.zones,
            "gold.dim_zones": self.dim,
            "gold.fct_trips": self.fact,
            "gold.mart_pickup_activity": self.pickup_mart,
            "gold.mart_monthly_activity": self.monthly_mart,
            "gold.mart_route_duration": self.route_mart,
            "ops.month_status": self.status,
        }

    @cached_property
    def tables(self) -> checks.Tables:
        return checks.Tables(
            bronze=self.bronze,
            trips=self.trips,
            rejected=self.rejected,
            status=self.status,
            dim=self.dim,
            fact=self.fact,
            pickup_mart=self.pickup_mart,
            monthly_mart=self.monthly_mart,
            route_mart=self.route_mart,
        )


class FaultyFeed(Feed):
    """The same feed with one known fault for every check to find."""

    @cached_property
    def status(self) -> DataFrame:
        month = F.col("source_month")
        return (
            super()
            .status.where(month != UNTRACKED_MONTH)
            .withColumns(
                {
                    "status": F.when(month == FAILED_MONTH, "FAILED").when(
                        month != UNSTATED_MONTH, F.col("status")
                    ),
                    "run_id": F.when(month == STALE_MONTH, OTHER_RUN_ID).otherwise(
                        F.col("run_id")
                    ),
                    "accepted_count": F.col("accepted_count")
                    + F.when(month == MISCOUNTED_MONTH, 1).otherwise(0),
                }
            )
        )

    @cached_property
    def rejected(self) -> DataFrame:
        blanked = F.col("source_month") == BLANKED_MONTH
        return super().rejected.withColumn(
            "rejection_reasons",
            F.when(~blanked, F.col("rejection_reasons")).otherwise(F.array().cast("array<string>")),
        )

    @cached_property
    def faulty_dim(self) -> DataFrame:
        key = F.col("zone_key")
        return self.dim.where(key != MISSING_ZONE).unionByName(
            self.dim.where(key == REPEATED_ZONE)
        )

    @cached_property
    def faulty_fact(self) -> DataFrame:
        minutes = F.col("duration_minutes")
        return self.fact.withColumn(
            "duration_minutes", F.when(minutes == 0, F.lit(-1)).otherwise(minutes)
        )

    @cached_property
    def tables(self) -> checks.Tables:
        lost = F.when(F.col("pickup_month") == SHIFTED_MONTH, 1).otherwise(0)
        gained = F.when(F.col("source_month") == SHIFTED_MONTH, 1).otherwise(0)
        return checks.Tables(
            bronze=self.bronze,
            trips=self.trips,
            rejected=self.rejected,
            status=self.status,
            dim=self.faulty_dim,
            fact=self.faulty_fact,
            pickup_mart=self.pickup_mart.withColumn(
                "recorded_fare_amount", F.col("recorded_fare_amount") + gained
            ),
            monthly_mart=self.monthly_mart.withColumn("trip_count", F.col("trip_count") - lost),
            route_mart=self.route_mart,
        )


class Staged:
    """For reports that read the validated records in many branches: written out once."""

    @cached_property
    def validated(self) -> DataFrame:
        return stage(super().validated, "validated")


class StagedFeed(Staged, Feed):
    pass


class StagedZonesFeed(StagedFeed):
    """The lookup is written out too, for reports over all layers that join it many times."""

    @cached_property
    def zones(self) -> DataFrame:
        return stage(super().zones, "zones")


class StagedFaultyFeed(Staged, FaultyFeed):
    pass


RECORD_COLUMNS = (
    "pickup_at",
    "dropoff_at",
    "pickup_zone_id",
    "dropoff_zone_id",
    "trip_distance_miles",
    "fare_amount",
    "total_amount",
    "source_month",
    "source_filename",
    "rejection_reasons",
    "quality_warnings",
    "duration_minutes",
)
STG_ONLY = tuple(models.STG_COLUMNS)
FACT_ONLY = ("pickup_zone_name", "pickup_borough", "dropoff_zone_name", "dropoff_borough")
BRONZE_COLUMNS = (
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "PULocationID",
    "DOLocationID",
    "trip_distance",
    "fare_amount",
    "total_amount",
    "l_returnflag",
    "l_linestatus",
    "o_orderstatus",
    "c_mktsegment",
)


def bronze_trips(f: Feed) -> DataFrame:
    return f.bronze.select(*BRONZE_COLUMNS, "source_month", "source_filename")


def _tagged(f: Feed, codes: str) -> DataFrame:
    return f.validated.groupBy(codes).agg(F.count("*").alias("row_count"))


def rejection_reasons(f: Feed) -> DataFrame:
    return _tagged(f, "rejection_reasons")


def quality_warnings(f: Feed) -> DataFrame:
    return _tagged(f, "quality_warnings")


def validated_trips(f: Feed) -> DataFrame:
    return f.validated.select(*RECORD_COLUMNS)


def accepted_trips(f: Feed) -> DataFrame:
    return f.trips.select(*RECORD_COLUMNS)


def rejected_trips(f: Feed) -> DataFrame:
    return f.rejected.select(*RECORD_COLUMNS)


def split_counts(f: Feed) -> DataFrame:
    return f.counts


def dim_zones(f: Feed) -> DataFrame:
    return f.dim


def stg_trips(f: Feed) -> DataFrame:
    return f.stg.select(*RECORD_COLUMNS, *STG_ONLY)


def fct_trips(f: Feed) -> DataFrame:
    return f.fact.select(*RECORD_COLUMNS, *STG_ONLY, *FACT_ONLY)


def mart_pickup_activity(f: Feed) -> DataFrame:
    return f.pickup_mart


def mart_monthly_activity(f: Feed) -> DataFrame:
    return f.monthly_mart


def mart_route_duration(f: Feed) -> DataFrame:
    return f.route_mart


def top_zone_hours(f: Feed) -> DataFrame:
    return answers.top_zone_hours(f.pickup_mart)


def monthly_change(f: Feed) -> DataFrame:
    return answers.monthly_change(f.monthly_mart, FIRST_MONTH, LAST_MONTH)


def slow_routes(f: Feed) -> DataFrame:
    return answers.slow_routes(f.route_mart, MIN_ROUTE_TRIPS)


def rejection_breakdown(f: Feed) -> DataFrame:
    return answers.rejection_breakdown(f.rejected)


def warning_breakdown(f: Feed) -> DataFrame:
    return answers.warning_breakdown(f.trips)


def zone_contract(f: FaultyFeed) -> DataFrame:
    broken = f.faulty_dim.withColumn(
        "zone_id", F.when(F.col("zone_key") != "1995-05:9", F.col("zone_id"))
    )
    return contracts.zone_violations(broken)


def zone_contract_raw(f: Feed) -> DataFrame:
    """The lookup as text with a month without lines, ids that are none, and repeated ones."""
    month, text = F.col("source_month"), F.col("LocationID")
    lines = f.raw_zones.where(month != ZONELESS_MONTH).withColumn(
        "LocationID",
        F.when(month == ODD_MONTH, F.concat(F.lit("zone "), text))
        .when((month == BLANK_MONTH) & (text < "2"), F.lit(None))
        .otherwise(text),
    )
    again = lines.where((month == TWICE_MONTH) & (F.length("LocationID") == 1)).withColumn(
        "LocationID", F.concat(F.lit("0"), text)
    )
    requested = f.raw_zones.select("source_month").distinct()
    return contracts.raw_zone_violations(lines.unionByName(again), requested)


def _gated(f: Feed, answer: DataFrame) -> DataFrame:
    names = ("months_are_ready", "gold_generation_matches", "aggregate_totals_reconcile")
    tables = replace(f.tables, known_states=stage(f.tables.states, "gate-states"))
    return answers.gated(answer, {name: checks.CHECKS[name](tables) for name in names})


def gated_zone_hours(f: Feed) -> DataFrame:
    return _gated(f, answers.top_zone_hours(f.pickup_mart))


def gated_routes(f: Feed) -> DataFrame:
    return _gated(f, answers.slow_routes(f.route_mart, MIN_ROUTE_TRIPS))


def month_texts(f: Feed) -> DataFrame:
    """Month texts as orders might carry them, some of them no month at all."""
    texts = orders_feed.read_table(f.spark, f.folder, "orders").select(
        F.format_string("%d-%02d", F.year("o_orderdate"), F.col("o_orderkey") % 15).alias("text")
    )
    return month_contract(texts, "text")


def readiness_violations(f: FaultyFeed) -> DataFrame:
    requested = contracts.requested_frame(f.status, REQUESTED_MONTHS)
    return contracts.readiness_violations(f.status, requested)


def check_months_ready(f: FaultyFeed) -> DataFrame:
    return checks.months_are_ready(f.tables).select("source_month", "status")


def check_prep_generation(f: FaultyFeed) -> DataFrame:
    return checks.preparation_generation_matches(f.tables)


def check_rejection_reasons(f: FaultyFeed) -> DataFrame:
    return checks.rejections_have_reasons(f.tables).select(*RECORD_COLUMNS)


def check_source_counts(f: FaultyFeed) -> DataFrame:
    return checks.source_counts_reconcile(f.tables)


def check_dimension_keys(f: FaultyFeed) -> DataFrame:
    return checks.dimension_keys(f.tables)


def check_fact_relationships(f: FaultyFeed) -> DataFrame:
    return checks.fact_relationships(f.tables)


def check_gold_generation(f: FaultyFeed) -> DataFrame:
    return checks.gold_generation_matches(f.tables)


def check_valid_journeys(f: FaultyFeed) -> DataFrame:
    return checks.valid_journeys(f.tables).select(*RECORD_COLUMNS)


def check_totals(f: FaultyFeed) -> DataFrame:
    return checks.aggregate_totals_reconcile(f.tables)


def check_report(f: FaultyFeed) -> DataFrame:
    return checks.check_report(f.tables)


def domain_conformance(f: Feed) -> DataFrame:
    """Declared on purpose without some values, so that violations show."""
    return contracts.domain_conformance(
        f.bronze,
        {
            "l_returnflag": F.col("l_returnflag").isin("A", "N"),
            "l_linestatus": F.col("l_linestatus").isin("O", "F"),
            "o_orderstatus": F.col("o_orderstatus").isin("O", "F"),
            "fare_amount": F.col("fare_amount") >= 0,
        },
    )


def dictionary_report(f: Feed) -> DataFrame:
    """Every column of every layer with its type, fill and definition."""
    return contracts.dictionary(f.layers).drop("nullable")


def dictionary_gaps(f: Feed) -> DataFrame:
    """Columns of any layer that the dictionary lacks, with their fill."""
    return contracts.dictionary_gaps(f.layers, with_populated=True).drop("nullable")


def column_profile(f: Feed) -> DataFrame:
    return profile.of_tables(
        f.sources, lambda frame: profile.column_profile(frame, with_distinct=False)
    )


def column_profile_distinct(f: Feed) -> DataFrame:
    """Exact distinct counts, and whether the sketch lies within its error of them."""
    sketch = profile.of_tables(f.sources, profile.column_profile).select(
        "table_name", "source_month", "column_name", "distinct_approx"
    )
    off = F.abs(F.col("distinct_approx") - F.col("distinct_exact"))
    return (
        profile.of_tables(f.sources, profile.distinct_counts)
        .join(sketch, ["table_name", "source_month", "column_name"])
        .select(
            "table_name",
            "source_month",
            "column_name",
            "distinct_exact",
            (off <= SKETCH_ERROR * F.col("distinct_exact")).alias("sketch_is_near"),
        )
    )


def _repeated(f: Feed) -> dict[str, DataFrame]:
    """Source records, some of them twice: those that stay in one zone, and Asia's zones;
    all source columns count."""
    stays = F.col("PULocationID") == F.col("DOLocationID")
    return {
        "bronze.yellow_trips": f.bronze.unionByName(f.bronze.where(stays)),
        "bronze.taxi_zones": f.raw_zones.unionByName(f.raw_zones.where("Borough = 'ASIA'")),
    }


def duplicate_groups(f: Feed) -> DataFrame:
    return profile.duplicate_groups(_repeated(f)["bronze.yellow_trips"])


def duplicate_zones(f: Feed) -> DataFrame:
    return profile.duplicate_groups(_repeated(f)["bronze.taxi_zones"])


def duplicate_excess(f: Feed) -> DataFrame:
    return profile.of_tables(_repeated(f), profile.duplicate_counts)


def category_counts(f: Feed) -> DataFrame:
    return profile.of_tables(
        f.sources, lambda frame: profile.category_counts(frame, CATEGORIES)
    )


def gold_increment(f: Feed) -> DataFrame:
    """Three months through the month jobs and two gold builds, the second of which adds one
    month to what the first one published; a month is prepared twice in between.

    The tables are those of a feed of their own, named anew at each call."""
    store = MonthStore(f.spark, FeedConfig(prefix=f"increment_{uuid.uuid4().hex[:8]}"))
    store.bootstrap()

    def prepared(month: str, run_id: str) -> None:
        for name, frame in (("yellow_trips", f.bronze), ("taxi_zones", f.raw_zones)):
            of_month = frame.where(F.col("source_month") == month)
            store.replace_month(of_month, "bronze", name, month)
        prepare_month(store, month, run_id)

    *first, last = INCREMENT_MONTHS
    for month in first:
        prepared(month, RUN_ID)
    build_gold(store, first)
    prepared(first[-1], OTHER_RUN_ID)
    prepared(last, OTHER_RUN_ID)
    build_gold(store, INCREMENT_MONTHS)
    return store.table("gold", "mart_monthly_activity")


def month_status(f: Feed) -> DataFrame:
    return f.status


def status_pct(f: Feed) -> DataFrame:
    return answers.status_pct(f.status)


def status_reconciled(f: FaultyFeed) -> DataFrame:
    return answers.status_reconciled(f.status)


def sensitivity(f: Feed) -> DataFrame:
    return answers.sensitivity(f.trips)


def snapshot_metrics(f: Feed) -> DataFrame:
    return snapshot.snapshot_metrics(f.lookups, f.validated)


def snapshot_diff(f: Feed) -> DataFrame:
    """Against a replay that dropped one month's quarantine and moved one month's fares."""
    kept = F.size("rejection_reasons") == 0
    moved = F.when(kept & (F.col("source_month") == SHIFTED_MONTH), 1).otherwise(0)
    replayed = f.validated.where(kept | (F.col("source_month") != BLANKED_MONTH)).withColumn(
        "fare_amount", F.col("fare_amount") + moved
    )
    return snapshot.snapshot_diff(
        snapshot.snapshot_metrics(f.lookups, f.validated),
        snapshot.snapshot_metrics(f.lookups, replayed),
    )


CLEAN_QUERIES = (
    bronze_trips,
    rejection_reasons,
    quality_warnings,
    validated_trips,
    accepted_trips,
    rejected_trips,
    split_counts,
    dim_zones,
    stg_trips,
    fct_trips,
    mart_pickup_activity,
    mart_monthly_activity,
    mart_route_duration,
    top_zone_hours,
    monthly_change,
    slow_routes,
    rejection_breakdown,
    warning_breakdown,
    zone_contract_raw,
    gated_zone_hours,
    gated_routes,
    month_texts,
    domain_conformance,
    dictionary_report,
    dictionary_gaps,
    column_profile,
    column_profile_distinct,
    duplicate_groups,
    duplicate_zones,
    duplicate_excess,
    category_counts,
    gold_increment,
    month_status,
    status_pct,
    sensitivity,
    snapshot_metrics,
    snapshot_diff,
)
FAULT_QUERIES = (
    zone_contract,
    readiness_violations,
    check_months_ready,
    check_prep_generation,
    check_rejection_reasons,
    check_source_counts,
    check_dimension_keys,
    check_fact_relationships,
    check_gold_generation,
    check_valid_journeys,
    check_totals,
    check_report,
    status_reconciled,
)
STAGED_QUERIES = (gated_zone_hours, gated_routes, dictionary_report)
STAGED_ZONES_QUERIES = (dictionary_gaps,)
STAGED_FAULT_QUERIES = (check_report, check_totals, check_source_counts)


def _runner(query, feed):
    return lambda spark, folder: comparable(query(feed(spark, folder)))


QUERIES = {
    **{query.__name__: _runner(query, Feed) for query in CLEAN_QUERIES},
    **{query.__name__: _runner(query, FaultyFeed) for query in FAULT_QUERIES},
    **{query.__name__: _runner(query, StagedFeed) for query in STAGED_QUERIES},
    **{query.__name__: _runner(query, StagedZonesFeed) for query in STAGED_ZONES_QUERIES},
    **{query.__name__: _runner(query, StagedFaultyFeed) for query in STAGED_FAULT_QUERIES},
}
