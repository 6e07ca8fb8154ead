"""The data dictionary: meaning, expected domain and origin of every column."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHARGE_DOMAIN = "0 or more; negative adjustments are kept and looked into"
CHARGE_ORIGIN = "source file, bronze only"
COUNT_DOMAIN = "0 or more"
MONTH_DOMAIN = "YYYY-MM"
RUN_DOMAIN = "1 to 256 characters"
NAME_DOMAIN = "names in the month's lookup; NULL if the key is unknown"
KEY_DOMAIN = "YYYY-MM:id"
KEY_ORIGIN = "source_month and the zone id, joined by a colon"
FACT_ORIGIN = "zone dimension, left join on the zone key"

# column: (description, domain, lineage)
FIELDS = {
    # source trips
    "VendorID": ("Provider code", "1, 2, 6, 7", CHARGE_ORIGIN),
    "tpep_pickup_datetime": ("Recorded start", "a timestamp, any month", "source file"),
    "tpep_dropoff_datetime": ("Recorded end", "a timestamp, not before the start", "source file"),
    "passenger_count": ("Passengers as entered", "whole number, 0 or more", CHARGE_ORIGIN),
    "trip_distance": ("Distance in miles", "above 0, up to 100 unremarked", "source file"),
    "RatecodeID": ("Rate code", "1 to 6, or 99", CHARGE_ORIGIN),
    "store_and_fwd_flag": ("Whether the record was sent late", "Y, N", CHARGE_ORIGIN),
    "PULocationID": ("Pickup zone", "an id in the lookup", "source file"),
    "DOLocationID": ("Dropoff zone", "an id in the lookup", "source file"),
    "payment_type": ("Payment code", "0 to 6", CHARGE_ORIGIN),
    "extra": ("Extras, USD", CHARGE_DOMAIN, CHARGE_ORIGIN),
    "mta_tax": ("Transit tax, USD", CHARGE_DOMAIN, CHARGE_ORIGIN),
    "tip_amount": ("Tip by card, USD", CHARGE_DOMAIN, CHARGE_ORIGIN),
    "tolls_amount": ("Tolls, USD", CHARGE_DOMAIN, CHARGE_ORIGIN),
    "improvement_surcharge": ("Improvement surcharge, USD", CHARGE_DOMAIN, CHARGE_ORIGIN),
    "congestion_surcharge": ("State congestion surcharge, USD", CHARGE_DOMAIN, CHARGE_ORIGIN),
    "airport_fee": ("Airport pickup fee, USD", CHARGE_DOMAIN, CHARGE_ORIGIN),
    "cbd_congestion_fee": ("Business district charge, USD", CHARGE_DOMAIN, CHARGE_ORIGIN),
    # source zones
    "LocationID": ("Zone id as text", "an integer, once per month", "lookup file"),
    "Borough": ("Borough of the zone", "as published", "lookup file"),
    "Zone": ("Name of the zone", "as published", "lookup file"),
    "service_zone": ("Service class of the zone", "as published, may be NULL", "lookup file"),
    # provenance
    "source_month": ("Month of the file or snapshot", MONTH_DOMAIN, "ingestion parameter"),
    "source_filename": ("File the row came from", "a file name", "ingestion path"),
    "ingested_at": ("When the row was ingested", "a timestamp", "clock"),
    "ingestion_run_id": ("Run that ingested the row", RUN_DOMAIN, "ingestion parameter"),
    "preparation_run_id": ("Run that prepared the row", RUN_DOMAIN, "preparation parameter"),
    # silver
    "pickup_at": ("Local start", "never NULL when accepted", "tpep_pickup_datetime, cast"),
    "dropoff_at": ("Local end", "not before the start when accepted",
                   "tpep_dropoff_datetime, cast"),
    "pickup_zone_id": ("Pickup zone id", "an id in the lookup when accepted",
                       "PULocationID, cast"),
    "dropoff_zone_id": ("Dropoff zone id", "an id in the lookup when accepted",
                        "DOLocationID, cast"),
    "zone_id": ("Zone id", "once per month", "LocationID, cast"),
    "trip_distance_miles": ("Distance in miles", "outside (0, 100] is warned",
                            "trip_distance, cast"),
    "fare_amount": ("Fare, USD", "outside 0 to 500 is warned", "source file; decimal in silver"),
    "total_amount": ("Total, USD", "below 0 is warned, no ceiling",
                     "source file; decimal in silver"),
    "duration_minutes": ("Minutes from start to end", "0 or more when accepted",
                         "whole seconds between start and end over 60"),
    "rejection_reasons": ("Rules that refused the record", "empty when accepted",
                          "rejection rules, in order"),
    "quality_warnings": ("Rules that question the record", "any combination",
                         "warning rules, in order"),
    "outcome": ("Where the record went", "accepted, rejected", "rejection_reasons"),
    "borough": ("Borough of the zone", "as in the month's lookup", "Borough"),
    "zone_name": ("Name of the zone", "as in the month's lookup", "Zone"),
    # gold
    "zone_key": ("Zone within a month", KEY_DOMAIN, KEY_ORIGIN),
    "pickup_zone_key": ("Pickup zone within the file month", KEY_DOMAIN, KEY_ORIGIN),
    "dropoff_zone_key": ("Dropoff zone within the file month", KEY_DOMAIN, KEY_ORIGIN),
    "pickup_date": ("Local start date", "a date", "pickup_at"),
    "pickup_month": ("Calendar month of the start", "YYYY-MM, may differ from source_month",
                     "pickup_at"),
    "pickup_hour": ("Local start hour", "0 to 23", "pickup_at"),
    "has_quality_warning": ("Whether any warning was raised", "true, false", "quality_warnings"),
    "pickup_zone_name": ("Name of the pickup zone", NAME_DOMAIN, FACT_ORIGIN),
    "pickup_borough": ("Borough of the pickup zone", NAME_DOMAIN, FACT_ORIGIN),
    "dropoff_zone_name": ("Name of the dropoff zone", NAME_DOMAIN, FACT_ORIGIN),
    "dropoff_borough": ("Borough of the dropoff zone", NAME_DOMAIN, FACT_ORIGIN),
    "trip_count": ("Accepted records in the group", "1 or more", "count over the fact"),
    "recorded_fare_amount": ("Sum of fares", "may be negative; 0 if no fare is known",
                             "sum over the fact, warned records included"),
    "recorded_total_amount": ("Sum of totals", "may be negative; 0 if no total is known",
                              "sum over the fact, warned records included"),
    "missing_fare_count": ("Records without a fare", "0 up to trip_count", "count over the fact"),
    "unusual_trip_count": ("Records with a warning", "0 up to trip_count", "count over the fact"),
    "average_duration_minutes": ("Mean duration", "0 or more", "average over the fact"),
    "median_duration_minutes": ("Lower median duration", "0 or more",
                                "exact, from counts of equal durations"),
    # ops
    "run_id": ("Run that wrote the row", RUN_DOMAIN, "job parameter"),
    "status": ("State of the month or of the step",
               "month: RUNNING, INGESTED, SUCCESS, FAILED; event: STARTED, SUCCESS, FAILED",
               "jobs"),
    "service": ("Step that logged the event", "ingestion, preparation, pipeline", "jobs"),
    "event_time": ("When the event happened", "a timestamp", "clock"),
    "error_type": ("Class of the error", "NULL unless the step failed", "jobs"),
    "input_count": ("Raw records of the month", COUNT_DOMAIN, "count over bronze"),
    "accepted_count": ("Accepted records", COUNT_DOMAIN, "count over silver"),
    "rejected_count": ("Rejected records", COUNT_DOMAIN, "count over silver"),
    "unusual_count": ("Accepted records with a warning", COUNT_DOMAIN, "count over silver"),
    "updated_at": ("When the status was written", "a timestamp", "clock"),
    "model": ("Model of a gold generation", "a model's name", "gold build"),
    "folder": ("Where a month of a model lies", "a path", "gold build"),
    "generation": ("Gold generation", "running number and a random part", "gold build"),
    "test_run_id": ("Replay test", RUN_DOMAIN, "replay parameter"),
    "stage": ("Stage of the replay test", "BEFORE, AFTER, PASS, FAIL", "replay test"),
    "recorded_at": ("When the evidence was written", "a timestamp", "clock"),
    "evidence_json": ("Metrics of one table-month, or the outcome", "JSON", "replay test"),
}

# layer.table: grain
TABLES = {
    "bronze.yellow_trips": "One raw record, with the file's own columns and types",
    "bronze.taxi_zones": "One lookup line per month, as text",
    "silver.validated_trips": "One typed record, accepted or rejected",
    "silver.trips": "One accepted record",
    "silver.rejected_trips": "One rejected record",
    "silver.taxi_zones": "One zone per month",
    "gold.dim_zones": "One zone per month, with its key",
    "gold.stg_trips": "One accepted record with keys and calendar columns",
    "gold.fct_trips": "One accepted record with zone names",
    "gold.mart_pickup_activity": "File month, pickup zone and hour",
    "gold.mart_monthly_activity": "Calendar month of pickup",
    "gold.mart_route_duration": "File month and route",
    "ops.run_events": "One event of a step, append only",
    "ops.month_status": "One row per month",
    "ops.gold_parts": "One month of one model in a generation",
    "ops.reprocessing_evidence": "One piece of evidence of a replay test",
}

_BY_KEY = {name.casefold(): entry for name, entry in FIELDS.items()}


def definitions_frame(spark: SparkSession) -> DataFrame:
    # A few names differ by case only ("Borough", "borough"); the first stands for both.
    first = {}
    for name, entry in FIELDS.items():
        first.setdefault(name.casefold(), (name, *entry))
    return spark.createDataFrame(
        list(first.values()), "field string, description string, domain string, lineage string"
    )


def undefined_columns(frame: DataFrame) -> list[str]:
    return [name for name in frame.columns if name.casefold() not in _BY_KEY]


def with_comments(frame: DataFrame) -> DataFrame:
    """Attach each column's dictionary entry, so that tables are created with comments."""
    columns = []
    for name in frame.columns:
        entry = FIELDS.get(name) or _BY_KEY.get(name.casefold())
        column = F.col(f"`{name}`")
        if entry:
            description, domain, lineage = entry
            comment = f"{description}. Domain: {domain}. Origin: {lineage}."
            column = column.alias(name, metadata={"comment": comment})
        columns.append(column)
    return frame.select(*columns)
