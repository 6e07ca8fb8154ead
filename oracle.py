"""SQL text, for an independent engine, that each named query must agree with.

The text repeats definitions instead of sharing code with the package; only the words of the
data dictionary are taken from it.  Arrays, decimals and times are compared as text."""

from tripfold.sources.dictionary import FIELDS

TRIPS = """
trips_base AS (
    SELECT
        *,
        o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER))
            - CASE WHEN l_linenumber = 1 THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END AS base,
        CAST(floor(l_extendedprice / 200) AS DOUBLE) AS fare
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN supplier ON l_suppkey = s_suppkey
), bronze AS (
    SELECT
        CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE base END AS tpep_pickup_datetime,
        base + to_seconds((7 * l_partkey + 13 * l_suppkey + 101 * l_linenumber) % 14400 - 600)
            AS tpep_dropoff_datetime,
        c_nationkey AS PULocationID,
        s_nationkey AS DOLocationID,
        2.5::DOUBLE * l_quantity - 5 AS trip_distance,
        CASE WHEN l_partkey % 50 = 0 THEN NULL
             WHEN l_linenumber = 7 AND l_partkey % 3 = 0 THEN -fare
             ELSE fare END AS fare_amount,
        CASE WHEN l_partkey % 50 = 0 THEN NULL
             WHEN l_linenumber = 7 AND l_partkey % 3 = 0 THEN -fare
             ELSE fare + 2 END AS total_amount,
        l_returnflag, l_linestatus, o_orderstatus, c_mktsegment,
        strftime(o_orderdate, '%Y-%m') AS source_month,
        'yellow_tripdata_' || strftime(o_orderdate, '%Y-%m') || '.parquet' AS source_filename
    FROM trips_base
)"""

ZONES = """
months AS (
    SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS source_month FROM orders
), zones AS (
    SELECT n_nationkey AS zone_id, r_name AS borough, n_name AS zone_name,
           'Standard' AS service_zone, source_month
    FROM nation JOIN region ON n_regionkey = r_regionkey CROSS JOIN months
    WHERE n_nationkey <> 24
), raw_zones AS (
    SELECT CAST(zone_id AS VARCHAR) AS LocationID, borough AS Borough, zone_name AS Zone,
           service_zone, source_month
    FROM zones
)"""

VALIDATED = """
normalized AS (
    SELECT tpep_pickup_datetime AS pickup_at, tpep_dropoff_datetime AS dropoff_at,
           PULocationID AS pickup_zone_id, DOLocationID AS dropoff_zone_id,
           trip_distance AS trip_distance_miles,
           CAST(fare_amount AS DECIMAL(18, 2)) AS fare_amount,
           CAST(total_amount AS DECIMAL(18, 2)) AS total_amount,
           source_month, source_filename
    FROM bronze
), validated AS (
    SELECT n.*,
        concat_ws('|',
            CASE WHEN pickup_at IS NULL OR dropoff_at IS NULL
                 THEN 'missing_or_invalid_timestamp' END,
            CASE WHEN dropoff_at < pickup_at THEN 'reversed_journey' END,
            CASE WHEN p.zone_id IS NULL THEN 'invalid_pickup_zone' END,
            CASE WHEN d.zone_id IS NULL THEN 'invalid_dropoff_zone' END) AS rejection_reasons,
        concat_ws('|',
            CASE WHEN trip_distance_miles IS NULL OR coalesce(isnan(trip_distance_miles), false)
                      OR trip_distance_miles <= 0 OR trip_distance_miles > 100
                 THEN 'unusual_distance' END,
            CASE WHEN fare_amount IS NULL OR fare_amount < 0 OR fare_amount > 500
                 THEN 'unusual_fare' END,
            CASE WHEN total_amount IS NULL OR total_amount < 0 THEN 'unusual_total' END,
            CASE WHEN strftime(pickup_at, '%Y-%m') <> n.source_month
                 THEN 'pickup_outside_source_month' END) AS quality_warnings,
        CAST(datesub('second', pickup_at, dropoff_at) / 60.0 AS DECIMAL(27, 6))
            AS duration_minutes
    FROM normalized n
    LEFT JOIN zones p ON p.source_month = n.source_month AND p.zone_id = n.pickup_zone_id
    LEFT JOIN zones d ON d.source_month = n.source_month AND d.zone_id = n.dropoff_zone_id
), trips AS (
    SELECT * FROM validated WHERE rejection_reasons = ''
), rejected AS (
    SELECT * FROM validated WHERE rejection_reasons <> ''
)"""

GOLD = """
dim AS (
    SELECT source_month || ':' || CAST(zone_id AS VARCHAR) AS zone_key, source_month, zone_id,
           borough, zone_name, service_zone
    FROM zones
), stg AS (
    SELECT *,
        source_month || ':' || CAST(pickup_zone_id AS VARCHAR) AS pickup_zone_key,
        source_month || ':' || CAST(dropoff_zone_id AS VARCHAR) AS dropoff_zone_key,
        CAST(pickup_at AS DATE) AS pickup_date,
        strftime(pickup_at, '%Y-%m') AS pickup_month,
        hour(pickup_at) AS pickup_hour,
        quality_warnings <> '' AS has_quality_warning
    FROM trips
), fact AS (
    SELECT s.*, p.zone_name AS pickup_zone_name, p.borough AS pickup_borough,
           d.zone_name AS dropoff_zone_name, d.borough AS dropoff_borough
    FROM stg s
    LEFT JOIN dim p ON s.pickup_zone_key = p.zone_key
    LEFT JOIN dim d ON s.dropoff_zone_key = d.zone_key
), pickup_mart AS (
    SELECT source_month, pickup_zone_id, pickup_zone_name, pickup_hour,
           count(*) AS trip_count,
           CAST(coalesce(sum(fare_amount), 0) AS DECIMAL(28, 2)) AS recorded_fare_amount,
           count(*) FILTER (WHERE has_quality_warning) AS unusual_trip_count
    FROM fact GROUP BY ALL
), monthly_mart AS (
    SELECT pickup_month, count(*) AS trip_count,
           CAST(coalesce(sum(fare_amount), 0) AS DECIMAL(28, 2)) AS recorded_fare_amount,
           CAST(coalesce(sum(total_amount), 0) AS DECIMAL(28, 2)) AS recorded_total_amount,
           count(*) FILTER (WHERE fare_amount IS NULL) AS missing_fare_count,
           count(*) FILTER (WHERE has_quality_warning) AS unusual_trip_count
    FROM fact GROUP BY ALL
), route_mart AS (
    SELECT source_month, pickup_zone_id, dropoff_zone_id, pickup_zone_name, dropoff_zone_name,
           count(*) AS trip_count,
           -- exact mean of the six-place values to ten places, half up
           CAST(CAST((20000 * sum(CAST(duration_minutes * 1000000 AS HUGEINT)) + count(*))
                // (2 * count(*)) AS DECIMAL(38, 0)) AS VARCHAR) AS average_digits,
           quantile_disc(duration_minutes, 0.5) AS median_duration_minutes,
           count(*) FILTER (WHERE has_quality_warning) AS unusual_trip_count
    FROM fact GROUP BY ALL
)"""

COUNTS = """
counts AS (
    SELECT source_month, count(*) AS input_count,
           count(*) FILTER (WHERE rejection_reasons = '') AS accepted_count,
           count(*) FILTER (WHERE rejection_reasons <> '') AS rejected_count,
           count(*) FILTER (WHERE rejection_reasons = '' AND quality_warnings <> '')
               AS unusual_count
    FROM validated GROUP BY source_month
), status AS (
    SELECT source_month, 'run-1' AS run_id, 'SUCCESS' AS status,
           input_count, accepted_count, rejected_count, unusual_count
    FROM counts
)"""

# The faults planted by the package's check queries.
FAULTS = """
bad_status AS (
    SELECT source_month,
           CASE WHEN source_month = '1997-05' THEN 'run-0' ELSE run_id END AS run_id,
           CASE WHEN source_month = '1996-02' THEN 'FAILED'
                WHEN source_month = '1996-03' THEN NULL ELSE status END AS status,
           input_count,
           accepted_count + CASE WHEN source_month = '1998-07' THEN 1 ELSE 0 END
               AS accepted_count,
           rejected_count, unusual_count
    FROM status WHERE source_month <> '1999-09'
), bad_rejected AS (
    SELECT * REPLACE (CASE WHEN source_month = '1996-06' THEN '' ELSE rejection_reasons END
                      AS rejection_reasons)
    FROM rejected
), bad_dim AS (
    SELECT * FROM dim WHERE zone_key <> '1995-04:7'
    UNION ALL SELECT * FROM dim WHERE zone_key = '1995-03:3'
), bad_fact AS (
    SELECT * REPLACE (CAST(CASE WHEN duration_minutes = 0 THEN -1 ELSE duration_minutes END
                           AS DECIMAL(27, 6)) AS duration_minutes)
    FROM fact
), bad_pickup_mart AS (
    SELECT * REPLACE (recorded_fare_amount + CASE WHEN source_month = '1996-04' THEN 1 ELSE 0 END
                      AS recorded_fare_amount)
    FROM pickup_mart
), bad_monthly_mart AS (
    SELECT * REPLACE (trip_count - CASE WHEN pickup_month = '1996-04' THEN 1 ELSE 0 END
                      AS trip_count)
    FROM monthly_mart
)"""

CHECKS = """
months_are_ready AS (
    SELECT source_month, status FROM bad_status WHERE status <> 'SUCCESS' OR status IS NULL
), preparation_generation_matches AS (
    SELECT t.source_month FROM trips t LEFT JOIN bad_status s USING (source_month)
    WHERE 'run-1' IS DISTINCT FROM s.run_id GROUP BY t.source_month
), gold_generation_matches AS (
    SELECT t.source_month FROM bad_fact t LEFT JOIN bad_status s USING (source_month)
    WHERE 'run-1' IS DISTINCT FROM s.run_id GROUP BY t.source_month
), rejections_have_reasons AS (
    SELECT * FROM bad_rejected WHERE rejection_reasons = ''
), counted AS (
    SELECT source_month, count(*) FILTER (kind = 'raw') AS raw_rows,
           count(*) FILTER (kind = 'kept') AS kept_rows,
           count(*) FILTER (kind = 'refused') AS refused_rows
    FROM (SELECT source_month, 'raw' AS kind FROM bronze
          UNION ALL SELECT source_month, 'kept' FROM trips
          UNION ALL SELECT source_month, 'refused' FROM bad_rejected)
    GROUP BY source_month
), source_counts_reconcile AS (
    SELECT coalesce(counted.source_month, told.source_month) AS source_month
    FROM counted FULL JOIN bad_status told ON told.source_month = counted.source_month
    WHERE (coalesce(told.status, 'SUCCESS') = 'SUCCESS' AND raw_rows > 0 AND kept_rows + refused_rows = raw_rows
           AND (told.input_count, told.accepted_count, told.rejected_count)
               = (raw_rows, kept_rows, refused_rows)) IS NOT TRUE
), dimension_keys AS (
    SELECT zone_key FROM bad_dim GROUP BY zone_key HAVING zone_key IS NULL OR count(*) <> 1
), fact_relationships AS (
    SELECT pickup_zone_key, dropoff_zone_key, count(*) AS trip_rows FROM bad_fact
    WHERE NOT EXISTS (SELECT 1 FROM bad_dim WHERE zone_key = pickup_zone_key)
       OR NOT EXISTS (SELECT 1 FROM bad_dim WHERE zone_key = dropoff_zone_key)
    GROUP BY ALL
), valid_journeys AS (
    SELECT * FROM bad_fact
    WHERE pickup_at IS NULL OR dropoff_at IS NULL OR duration_minutes < 0
       OR rejection_reasons <> ''
), per_model AS (
    SELECT model, sum(n) AS trips, sum(money) AS fares
    FROM (SELECT 'fact' AS model, 1 AS n, fare_amount AS money FROM bad_fact
          UNION ALL SELECT 'pickup', trip_count, recorded_fare_amount FROM bad_pickup_mart
          UNION ALL SELECT 'monthly', trip_count, recorded_fare_amount FROM bad_monthly_mart
          UNION ALL SELECT 'route', trip_count, 0 FROM route_mart)
    GROUP BY model
), aggregate_totals_reconcile AS (
    SELECT model, trips, CASE model WHEN 'route' THEN due.money ELSE fares END AS fares
    FROM per_model, (SELECT count(*) AS n, sum(fare_amount) AS money FROM trips) due
    WHERE trips <> due.n OR (model <> 'route' AND fares <> due.money)
)"""

CHECK_NAMES = (
    "months_are_ready",
    "preparation_generation_matches",
    "rejections_have_reasons",
    "source_counts_reconcile",
    "dimension_keys",
    "fact_relationships",
    "gold_generation_matches",
    "valid_journeys",
    "aggregate_totals_reconcile",
)

BRONZE_TYPES = {
    "tpep_pickup_datetime": "timestamp_ntz",
    "tpep_dropoff_datetime": "timestamp_ntz",
    "PULocationID": "int",
    "DOLocationID": "int",
    "trip_distance": "double",
    "fare_amount": "double",
    "total_amount": "double",
    "l_returnflag": "string",
    "l_linestatus": "string",
    "o_orderstatus": "string",
    "c_mktsegment": "string",
}
UNDEFINED = ("l_returnflag", "l_linestatus", "o_orderstatus", "c_mktsegment")
ZONE_TYPES = dict.fromkeys(("LocationID", "Borough", "Zone", "service_zone"), "string")
SOURCES = [
    *[("bronze.yellow_trips", "bronze", c, kind) for c, kind in BRONZE_TYPES.items()],
    *[("bronze.taxi_zones", "raw_zones", c, kind) for c, kind in ZONE_TYPES.items()],
]
CATEGORIES = (*UNDEFINED, "Borough", "service_zone")

BRONZE_OUT = """
    CAST(tpep_pickup_datetime AS VARCHAR) AS tpep_pickup_datetime,
    CAST(tpep_dropoff_datetime AS VARCHAR) AS tpep_dropoff_datetime,
    CAST(PULocationID AS BIGINT) AS PULocationID, CAST(DOLocationID AS BIGINT) AS DOLocationID,
    trip_distance, fare_amount, total_amount,
    l_returnflag, l_linestatus, o_orderstatus, c_mktsegment, source_month, source_filename"""
RECORD_OUT = """
    CAST(pickup_at AS VARCHAR) AS pickup_at, CAST(dropoff_at AS VARCHAR) AS dropoff_at,
    CAST(pickup_zone_id AS BIGINT) AS pickup_zone_id,
    CAST(dropoff_zone_id AS BIGINT) AS dropoff_zone_id, trip_distance_miles,
    CAST(fare_amount AS VARCHAR) AS fare_amount, CAST(total_amount AS VARCHAR) AS total_amount,
    source_month, source_filename, rejection_reasons, quality_warnings,
    CAST(duration_minutes AS VARCHAR) AS duration_minutes"""
STG_OUT = (
    RECORD_OUT
    + """, pickup_zone_key, dropoff_zone_key, CAST(pickup_date AS VARCHAR) AS pickup_date,
    pickup_month, CAST(pickup_hour AS BIGINT) AS pickup_hour, has_quality_warning"""
)
FACT_OUT = (
    STG_OUT + ", pickup_zone_name, pickup_borough, dropoff_zone_name, dropoff_borough"
)
DIM_OUT = "zone_key, source_month, CAST(zone_id AS BIGINT) AS zone_id, borough, zone_name, " \
          "service_zone"
MONTHLY_OUT = """
    pickup_month, trip_count, CAST(recorded_fare_amount AS VARCHAR) AS recorded_fare_amount,
    CAST(recorded_total_amount AS VARCHAR) AS recorded_total_amount,
    missing_fare_count, unusual_trip_count"""
ROUTE_OUT = """
    source_month, CAST(pickup_zone_id AS BIGINT) AS pickup_zone_id,
    CAST(dropoff_zone_id AS BIGINT) AS dropoff_zone_id, pickup_zone_name, dropoff_zone_name,
    trip_count,
    coalesce(nullif(left(lpad(average_digits, CAST(greatest(11, length(average_digits)) AS INTEGER), '0'), -10), ''), '0')
        || '.' || right(lpad(average_digits, CAST(greatest(11, length(average_digits)) AS INTEGER), '0'), 10) AS average_duration_minutes,
    CAST(median_duration_minutes AS VARCHAR) AS median_duration_minutes, unusual_trip_count"""


def _breakdown(source: str, codes: str, code: str, count: str) -> str:
    return f"""
        SELECT source_month, {code}, count(*) AS {count}
        FROM (SELECT source_month, unnest(string_split({codes}, '|')) AS {code} FROM {source}
              WHERE {codes} <> '')
        GROUP BY ALL"""


def _profile(table: str, source: str, column: str, kind: str) -> str:
    missing = f"{column} IS NULL"
    quartiles = "NULL"
    if kind == "string":
        missing += f" OR trim({column}) = ''"
    if kind == "double":
        missing += f" OR coalesce(isnan({column}), false)"
    if kind in ("int", "double"):
        quartiles = (
            f"array_to_string(CAST(quantile_disc(CAST({column} AS DOUBLE), [0.25, 0.5, 0.75]) "
            f"FILTER (WHERE NOT ({missing})) AS VARCHAR[]), '|')"
        )
    return f"""
        SELECT '{table}' AS table_name, source_month, '{column}' AS column_name,
               '{kind}' AS data_type, count(*) AS total, count(*) FILTER (WHERE {missing}) AS missing,
               100 * (count(*) FILTER (WHERE {missing})) / count(*) AS missing_pct,
               CAST(min({column}) AS VARCHAR) AS min_value,
               CAST(max({column}) AS VARCHAR) AS max_value,
               CAST({quartiles} AS VARCHAR) AS quartiles
        FROM {source} GROUP BY source_month"""


def _conformance(column: str, inside: str) -> str:
    return f"""
        SELECT source_month, '{column}' AS column_name,
               count(*) FILTER (WHERE {inside}) AS conforming,
               count(*) FILTER (WHERE {column} IS NOT NULL AND NOT ({inside})) AS violating,
               count(*) FILTER (WHERE {column} IS NULL) AS null_count
        FROM bronze GROUP BY source_month"""


MONTHS = {"source_month": "string"}
FILES = {**MONTHS, "source_filename": "string"}
INGESTED = {"ingested_at": "timestamp", "ingestion_run_id": "string"}
RECORD_TYPES = {
    "pickup_at": "timestamp_ntz",
    "dropoff_at": "timestamp_ntz",
    "pickup_zone_id": "int",
    "dropoff_zone_id": "int",
    "trip_distance_miles": "double",
    "fare_amount": "decimal(18,2)",
    "total_amount": "decimal(18,2)",
    **FILES,
    **INGESTED,
    "rejection_reasons": "array<string>",
    "quality_warnings": "array<string>",
    "duration_minutes": "decimal(27,6)",
    "preparation_run_id": "string",
}
LOOKUP_TYPES = {"zone_id": "int", **dict.fromkeys(("borough", "zone_name", "service_zone"), "string")}
FACT_TYPES = {
    **RECORD_TYPES,
    "pickup_zone_key": "string",
    "dropoff_zone_key": "string",
    "pickup_date": "date",
    "pickup_month": "string",
    "pickup_hour": "int",
    "has_quality_warning": "boolean",
    **dict.fromkeys(
        ("pickup_zone_name", "pickup_borough", "dropoff_zone_name", "dropoff_borough"), "string"
    ),
}
DICTIONARY_TABLES = {
    "bronze.yellow_trips": ("bronze", {**BRONZE_TYPES, **FILES, **INGESTED}),
    "bronze.taxi_zones": ("raw_zones", {**ZONE_TYPES, **MONTHS}),
    "silver.trips": ("trips", RECORD_TYPES),
    "silver.rejected_trips": ("rejected", RECORD_TYPES),
    "silver.taxi_zones": ("zones", {**LOOKUP_TYPES, **MONTHS}),
    "gold.dim_zones": ("dim", {"zone_key": "string", **MONTHS, **LOOKUP_TYPES}),
    "gold.fct_trips": ("fact", FACT_TYPES),
    "gold.mart_pickup_activity": (
        "pickup_mart",
        {
            **MONTHS,
            "pickup_zone_id": "int",
            "pickup_zone_name": "string",
            "pickup_hour": "int",
            "trip_count": "bigint",
            "recorded_fare_amount": "decimal(28,2)",
            "unusual_trip_count": "bigint",
        },
    ),
    "gold.mart_monthly_activity": (
        "monthly_mart",
        {
            "pickup_month": "string",
            "trip_count": "bigint",
            "recorded_fare_amount": "decimal(28,2)",
            "recorded_total_amount": "decimal(28,2)",
            "missing_fare_count": "bigint",
            "unusual_trip_count": "bigint",
        },
    ),
    "gold.mart_route_duration": (
        "route_mart",
        {
            **MONTHS,
            "pickup_zone_id": "int",
            "dropoff_zone_id": "int",
            "pickup_zone_name": "string",
            "dropoff_zone_name": "string",
            "trip_count": "bigint",
            "average_duration_minutes": "decimal(31,10)",
            "median_duration_minutes": "decimal(27,6)",
            "unusual_trip_count": "bigint",
        },
    ),
    "ops.month_status": (
        "status",
        {
            **MONTHS,
            "run_id": "string",
            "status": "string",
            **dict.fromkeys(
                ("input_count", "accepted_count", "rejected_count", "unusual_count"), "bigint"
            ),
        },
    ),
}
ALWAYS_FILLED = {*INGESTED, "preparation_run_id", "average_duration_minutes"}
WORDS = {}
for _field, _entry in FIELDS.items():
    WORDS.setdefault(_field.casefold(), _entry)


def _dictionary(table: str, source: str, columns: dict[str, str]) -> str:
    """All fills of a table in one row, turned into a row a column."""
    rows = []
    for column, kind in columns.items():
        fill = "count(*)" if column in ALWAYS_FILLED else f"count({column})"
        entry = WORDS.get(column.casefold())
        told = [
            "CAST(NULL AS VARCHAR)" if entry is None else "'" + text.replace("'", "''") + "'"
            for text in entry or (None,) * 3
        ]
        rows.append(
            f"{{'column_name': '{column}', 'data_type': '{kind}', 'populated': {fill}, "
            f"'description': {told[0]}, 'domain': {told[1]}, 'lineage': {told[2]}, "
            f"'is_defined': {str(entry is not None).lower()}}}"
        )
    return (
        f"SELECT '{table}' AS table_name, unnest(rows, recursive := true) "
        f"FROM (SELECT [{', '.join(rows)}] AS rows FROM {source})"
    )


DICTIONARY = " UNION ALL ".join(
    _dictionary(table, *about) for table, about in DICTIONARY_TABLES.items()
)


def _snapshot(table: str, source: str, amounts: bool, fare: str = "fare_amount") -> str:
    if amounts:
        metrics = f"""
            CAST(coalesce(sum(CAST({fare} AS DECIMAL(18, 2))), CAST(0 AS DECIMAL(28, 2))) AS VARCHAR)
                AS sum_fare_amount,
            CAST(count({fare}) AS BIGINT) AS populated_fare_amount,
            CAST(coalesce(sum(CAST(total_amount AS DECIMAL(18, 2))), CAST(0 AS DECIMAL(28, 2)))
                AS VARCHAR) AS sum_total_amount,
            CAST(count(total_amount) AS BIGINT) AS populated_total_amount"""
    else:
        metrics = """
            CAST(NULL AS VARCHAR) AS sum_fare_amount, CAST(NULL AS BIGINT) AS populated_fare_amount,
            CAST(NULL AS VARCHAR) AS sum_total_amount,
            CAST(NULL AS BIGINT) AS populated_total_amount"""
    return f"""
        SELECT '{table}' AS table_name, source_month, count(*) AS row_count, {metrics}
        FROM {source} GROUP BY source_month"""


SNAPSHOT = " UNION ALL ".join(
    [
        _snapshot("bronze.yellow_trips", "bronze", True),
        _snapshot("bronze.taxi_zones", "zones", False),
        _snapshot("silver.trips", "trips", True),
        _snapshot("silver.rejected_trips", "rejected", True),
        _snapshot("silver.taxi_zones", "zones", False),
    ]
)
REPLAYED = " UNION ALL ".join(
    [
        _snapshot("bronze.yellow_trips", "bronze", True),
        _snapshot("bronze.taxi_zones", "zones", False),
        _snapshot(
            "silver.trips",
            "trips",
            True,
            "(fare_amount + CASE WHEN source_month = '1996-04' THEN 1 ELSE 0 END)",
        ),
        _snapshot(
            "silver.rejected_trips",
            "(SELECT * FROM rejected WHERE source_month <> '1996-06')",
            True,
        ),
        _snapshot("silver.taxi_zones", "zones", False),
    ]
)

REPEATED = """SELECT * FROM bronze
    UNION ALL SELECT * FROM bronze WHERE PULocationID = DOLocationID"""
REPEATED_ZONES = """SELECT * FROM raw_zones
    UNION ALL SELECT * FROM raw_zones WHERE Borough = 'ASIA'"""
SOURCE_OUT = ", ".join(
    f"CAST({c} AS {'BIGINT' if kind == 'int' else 'VARCHAR'}) AS {c}"
    if kind in ("int", "timestamp_ntz")
    else c
    for c, kind in BRONZE_TYPES.items()
)

SELECTS = {
    "bronze_trips": f"SELECT {BRONZE_OUT} FROM bronze",
    "rejection_reasons":
        "SELECT rejection_reasons, count(*) AS row_count FROM validated GROUP BY ALL",
    "quality_warnings":
        "SELECT quality_warnings, count(*) AS row_count FROM validated GROUP BY ALL",
    "validated_trips": f"SELECT {RECORD_OUT} FROM validated",
    "accepted_trips": f"SELECT {RECORD_OUT} FROM trips",
    "rejected_trips": f"SELECT {RECORD_OUT} FROM rejected",
    "split_counts": "SELECT * FROM counts",
    "dim_zones": f"SELECT {DIM_OUT} FROM dim",
    "stg_trips": f"SELECT {STG_OUT} FROM stg",
    "fct_trips": f"SELECT {FACT_OUT} FROM fact",
    "mart_pickup_activity": """
        SELECT source_month, CAST(pickup_zone_id AS BIGINT) AS pickup_zone_id, pickup_zone_name,
               CAST(pickup_hour AS BIGINT) AS pickup_hour, trip_count,
               CAST(recorded_fare_amount AS VARCHAR) AS recorded_fare_amount, unusual_trip_count
        FROM pickup_mart""",
    "mart_monthly_activity": f"SELECT {MONTHLY_OUT} FROM monthly_mart",
    "mart_route_duration": f"SELECT {ROUTE_OUT} FROM route_mart",
    "top_zone_hours": """
        SELECT CAST(pickup_zone_id AS BIGINT) AS pickup_zone_id, pickup_zone_name,
               CAST(pickup_hour AS BIGINT) AS pickup_hour,
               CAST(sum(trip_count) AS BIGINT) AS completed_trips
        FROM pickup_mart GROUP BY ALL
        ORDER BY completed_trips DESC, pickup_zone_id, pickup_zone_name, pickup_hour LIMIT 20""",
    "monthly_change": f"""
        SELECT {MONTHLY_OUT},
               trip_count - lag(trip_count) OVER (ORDER BY pickup_month) AS trip_count_change
        FROM monthly_mart WHERE pickup_month BETWEEN '1995-01' AND '1995-12'
        ORDER BY pickup_month""",
    "slow_routes": f"""
        SELECT {ROUTE_OUT} FROM route_mart WHERE trip_count >= 5
        ORDER BY route_mart.median_duration_minutes DESC, source_month, pickup_zone_id, dropoff_zone_id,
                 pickup_zone_name, dropoff_zone_name LIMIT 20""",
    "rejection_breakdown":
        _breakdown("rejected", "rejection_reasons", "reason", "rejected_records_with_reason"),
    "warning_breakdown":
        _breakdown("trips", "quality_warnings", "warning", "accepted_records_with_warning"),
    "month_texts": """
        SELECT month_text, count(*) AS row_count,
               CAST(string_split(month_text, '-')[2] AS INTEGER) BETWEEN 1 AND 12 AS is_valid
        FROM (SELECT CAST(year(o_orderdate) AS VARCHAR) || '-'
                     || lpad(CAST(o_orderkey % 15 AS VARCHAR), 2, '0') AS month_text FROM orders)
        GROUP BY month_text""",
    "zone_contract": """
        SELECT source_month, zone_id, copies,
               CASE WHEN zone_id IS NULL THEN 'missing_id' ELSE 'repeated_id' END AS violation
        FROM (SELECT source_month,
                     CASE WHEN zone_key = '1995-05:9' THEN NULL ELSE CAST(zone_id AS BIGINT) END
                         AS zone_id,
                     count(*) AS copies
              FROM bad_dim GROUP BY ALL)
        WHERE zone_id IS NULL OR copies > 1""",
    "zone_contract_raw": """
        WITH lines AS (
            SELECT source_month,
                   CASE WHEN source_month = '1997-03' THEN 'zone ' || LocationID
                        WHEN source_month = '1997-04' AND LocationID < '2' THEN NULL
                        ELSE LocationID END AS id
            FROM raw_zones WHERE source_month <> '1997-02'
            UNION ALL
            SELECT source_month, '0' || LocationID FROM raw_zones
            WHERE source_month = '1997-06' AND length(LocationID) = 1)
        SELECT source_month, zone_id, copies,
               CASE WHEN zone_id IS NOT NULL THEN 'repeated_id'
                    WHEN written > 0 THEN 'uncastable_id' ELSE 'missing_id' END AS violation
        FROM (SELECT source_month, CAST(try_cast(id AS INTEGER) AS BIGINT) AS zone_id,
                     count(*) AS copies, count(id) AS written
              FROM lines GROUP BY source_month, CAST(try_cast(id AS INTEGER) AS BIGINT))
        WHERE zone_id IS NULL OR copies > 1
        UNION ALL
        SELECT DISTINCT source_month, CAST(NULL AS BIGINT), 0, 'empty_month' FROM raw_zones
        WHERE source_month NOT IN (SELECT source_month FROM lines)""",
    "readiness_violations": """
        SELECT source_month, 'not_success' AS violation FROM bad_status
        WHERE status <> 'SUCCESS' OR status IS NULL
        UNION ALL
        SELECT r.source_month, 'not_prepared'
        FROM (VALUES ('1995-01'), ('1996-02'), ('2031-01')) AS r(source_month)
        WHERE r.source_month NOT IN (SELECT source_month FROM bad_status)""",
    "check_months_ready": "SELECT * FROM months_are_ready",
    "check_prep_generation": "SELECT * FROM preparation_generation_matches",
    "check_rejection_reasons": f"SELECT {RECORD_OUT} FROM rejections_have_reasons",
    "check_source_counts": "SELECT * FROM source_counts_reconcile",
    "check_dimension_keys": "SELECT * FROM dimension_keys",
    "check_fact_relationships": "SELECT * FROM fact_relationships",
    "check_gold_generation": "SELECT * FROM gold_generation_matches",
    "check_valid_journeys": f"SELECT {RECORD_OUT} FROM valid_journeys",
    "check_totals": """
        SELECT model, CAST(trips AS BIGINT) AS trips,
               CAST(CAST(fares AS DECIMAL(38, 2)) AS VARCHAR) AS fares
        FROM aggregate_totals_reconcile""",
    "check_report": " UNION ALL ".join(
        f"SELECT '{name}' AS check_name, count(*) AS violations FROM {name}"
        for name in CHECK_NAMES
    ),
    "domain_conformance": " UNION ALL ".join(
        [
            _conformance("l_returnflag", "l_returnflag IN ('A', 'N')"),
            _conformance("l_linestatus", "l_linestatus IN ('O', 'F')"),
            _conformance("o_orderstatus", "o_orderstatus IN ('O', 'F')"),
            _conformance("fare_amount", "fare_amount >= 0"),
        ]
    ),
    "dictionary_report": DICTIONARY,
    "dictionary_gaps":
        "SELECT * EXCLUDE (is_defined, description, domain, lineage) "
        f"FROM ({DICTIONARY}) WHERE NOT is_defined",
    "column_profile": " UNION ALL ".join(_profile(*about) for about in SOURCES),
    "column_profile_distinct": " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, source_month, '{c}' AS column_name, "
        f"count(DISTINCT {c}) AS distinct_exact, "
        f"TRUE AS sketch_is_near FROM {source} GROUP BY source_month"
        for table, source, c, _ in SOURCES
    ),
    "duplicate_groups": f"""
        SELECT {SOURCE_OUT}, source_month, count(*) AS copies
        FROM ({REPEATED}) GROUP BY ALL HAVING count(*) > 1""",
    "duplicate_zones": f"""
        SELECT {', '.join(ZONE_TYPES)}, source_month, count(*) AS copies
        FROM ({REPEATED_ZONES}) GROUP BY ALL HAVING count(*) > 1""",
    "duplicate_excess": " UNION ALL ".join(
        f"""
        SELECT '{table}' AS table_name, source_month, count(*) AS identical_groups,
               CAST(sum(copies - 1) AS BIGINT) AS excess_identical_rows
        FROM (SELECT source_month, count(*) AS copies FROM ({source})
              GROUP BY source_month, {', '.join(columns)} HAVING count(*) > 1)
        GROUP BY source_month"""
        for table, source, columns in (
            ("bronze.yellow_trips", REPEATED, BRONZE_TYPES),
            ("bronze.taxi_zones", REPEATED_ZONES, ZONE_TYPES),
        )
    ),
    "category_counts": " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, source_month, '{c}' AS column_name, {c} AS value, "
        f"count(*) AS row_count FROM {source} GROUP BY ALL"
        for table, source, c, _ in SOURCES
        if c in CATEGORIES
    ),
    "gold_increment": f"""
        SELECT {MONTHLY_OUT}
        FROM (SELECT pickup_month, count(*) AS trip_count,
                     CAST(coalesce(sum(fare_amount), 0) AS DECIMAL(28, 2)) AS recorded_fare_amount,
                     CAST(coalesce(sum(total_amount), 0) AS DECIMAL(28, 2))
                         AS recorded_total_amount,
                     count(*) FILTER (WHERE fare_amount IS NULL) AS missing_fare_count,
                     count(*) FILTER (WHERE has_quality_warning) AS unusual_trip_count
              FROM fact WHERE source_month IN ('1995-01', '1995-02', '1995-03')
              GROUP BY pickup_month)""",
    "month_status": "SELECT * FROM status",
    "status_pct": """
        SELECT *, 100 * rejected_count / nullif(input_count, 0) AS rejected_pct,
               100 * unusual_count / nullif(accepted_count, 0) AS accepted_warning_pct
        FROM status""",
    "status_reconciled": """
        SELECT *, input_count = accepted_count + rejected_count AS reconciled FROM bad_status""",
    "sensitivity": """
        SELECT source_month, count(*) AS accepted, CAST(sum(fare_amount) AS VARCHAR) AS fare_all,
               CAST(sum(CASE WHEN NOT list_contains(string_split(quality_warnings, '|'),
                                                    'unusual_fare') THEN fare_amount END)
                    AS VARCHAR) AS fare_without_fare_warning,
               count(*) FILTER (WHERE duration_minutes = 0) AS zero_duration,
               count(*) FILTER (WHERE duration_minutes > 180) AS over_180_minutes,
               array_to_string(
                   CAST(quantile_disc(duration_minutes, [0.5, 0.95, 0.99]) AS VARCHAR[]), '|')
                   AS duration_percentiles
        FROM trips GROUP BY source_month""",
    "snapshot_metrics": SNAPSHOT,
    "snapshot_diff": f"""
        SELECT coalesce(b.table_name, a.table_name) AS table_name,
               coalesce(b.source_month, a.source_month) AS source_month,
               CASE WHEN b.table_name IS NULL THEN 'added'
                    WHEN a.table_name IS NULL THEN 'removed' ELSE 'changed' END AS change,
               b.row_count AS row_count_before, a.row_count AS row_count_after,
               b.sum_fare_amount AS sum_fare_amount_before,
               a.sum_fare_amount AS sum_fare_amount_after,
               b.populated_fare_amount AS populated_fare_amount_before,
               a.populated_fare_amount AS populated_fare_amount_after,
               b.sum_total_amount AS sum_total_amount_before,
               a.sum_total_amount AS sum_total_amount_after,
               b.populated_total_amount AS populated_total_amount_before,
               a.populated_total_amount AS populated_total_amount_after
        FROM ({SNAPSHOT}) b
        FULL JOIN ({REPLAYED}) a
          ON a.table_name = b.table_name AND a.source_month = b.source_month
        WHERE a IS DISTINCT FROM b""",
}

# The gates hold on sound tables, so the answers behind them are the plain ones.
SELECTS["gated_zone_hours"] = SELECTS["top_zone_hours"]
SELECTS["gated_routes"] = SELECTS["slow_routes"]


def statements() -> dict[str, str]:
    """Each statement carries every definition; the engine drops those it does not use."""
    definitions = ", ".join([TRIPS, ZONES, VALIDATED, GOLD, COUNTS, FAULTS, CHECKS])
    return {
        name: f"WITH {definitions} SELECT * FROM ({select})" if "WITH" in select
        else f"WITH {definitions} {select}"
        for name, select in SELECTS.items()
    }
