"""Order tables re-read as a monthly journey feed.

The tables hold no journeys, so times, places and defects are derived from keys.
One lineitem row becomes one raw record; nations act as the places."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripfold.functions.lookups import fits_broadcast
from tripfold.sources.landing import filename_column

ORDERS_LIMIT_BYTES = 32 * 1024 * 1024  # by key width; the joined row is about three times that
UNKNOWN_PLACE = 24  # the one nation left out of the place lookup
SERVICE_ZONE = "Standard"


# Layout of the tables (fixed values).  Stating it spares a footer-reading job per scan.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def placed_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with the customer's nation and everything that is the same for all items."""
    orders = read_table(spark, folder, "orders").join(
        read_table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    return orders.selectExpr(
        "o_orderkey",
        "o_orderstatus",
        "c_mktsegment",
        "c_nationkey",
        "o_orderdate + make_dt_interval(0, int(o_orderkey % 24)) AS placed_at",
        "date_format(date(o_orderdate), 'yyyy-MM') AS source_month",
    )


def raw_trips(spark: SparkSession, folder: str) -> DataFrame:
    """Raw records in the source layout, one per lineitem row.

    Orders meet customers first, so the widest input is shuffled for the order key and
    the supplier key only.  Orders are broadcast when their row count, which file footers
    give, proves them small; the inner join to customers adds no row."""
    items = read_table(spark, folder, "lineitem")
    orders = placed_orders(spark, folder)
    if fits_broadcast(read_table(spark, folder, "orders").select("o_orderkey"), ORDERS_LIMIT_BYTES):
        orders = F.broadcast(orders)
    joined = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        read_table(spark, folder, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")
    )

    fare = "double(floor(l_extendedprice / 200))"
    unpriced = "l_partkey % 50 = 0"
    refunded = "l_linenumber = 7 AND l_partkey % 3 = 0"
    return (
        joined.selectExpr(
            "*",
            "CASE WHEN l_linenumber = 1 THEN placed_at - interval 1 day ELSE placed_at END AS base",
            f"CASE WHEN {unpriced} THEN NULL WHEN {refunded} THEN -{fare} ELSE {fare} END "
            "AS fare_amount",
            f"CASE WHEN {unpriced} THEN NULL WHEN {refunded} THEN -{fare} ELSE {fare} + 2 END "
            "AS total_amount",
        )
        .selectExpr(
            "CASE WHEN l_orderkey % 97 <> 0 THEN base END AS tpep_pickup_datetime",
            "base + interval 1 second * "
            "((7 * l_partkey + 13 * l_suppkey + 101 * l_linenumber) % 14400 - 600) "
            "AS tpep_dropoff_datetime",
            "c_nationkey AS PULocationID",
            "s_nationkey AS DOLocationID",
            "2.5d * l_quantity - 5 AS trip_distance",
            "fare_amount",
            "total_amount",
            "l_returnflag",
            "l_linestatus",
            "o_orderstatus",
            "c_mktsegment",
            "source_month",
        )
        .select(
            "*",
            filename_column(F.col("source_month")).alias("source_filename"),
            F.current_timestamp().alias("ingested_at"),
            F.lit("feed").alias("ingestion_run_id"),
        )
    )


def places(spark: SparkSession, folder: str) -> DataFrame:
    """The place lookup in silver layout, one snapshot per month the orders span.

    The span comes from a scalar aggregate and each nation row is repeated by a
    generator, so no two inputs are paired."""
    span = read_table(spark, folder, "orders").selectExpr(
        "struct(date(min(o_orderdate)) AS first, date(max(o_orderdate)) AS last) AS span"
    )
    return (
        read_table(spark, folder, "nation")
        .where(f"n_nationkey <> {UNKNOWN_PLACE}")
        .join(read_table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .withColumn("span", span.scalar())
        .selectExpr(
            "*",
            "explode(sequence(trunc(span.first, 'month'), trunc(span.last, 'month'), "
            "interval 1 month)) AS month",
        )
        .selectExpr(
            "n_nationkey AS zone_id",
            "r_name AS borough",
            "n_name AS zone_name",
            f"'{SERVICE_ZONE}' AS service_zone",
            "date_format(month, 'yyyy-MM') AS source_month",
        )
    )


def raw_places(spark: SparkSession, folder: str) -> DataFrame:
    """The place lookup as its files carry it: text under the source's names."""
    return places(spark, folder).selectExpr(
        "CAST(zone_id AS string) AS LocationID",
        "borough AS Borough",
        "zone_name AS Zone",
        "service_zone",
        "source_month",
    )
