"""Landing files: names, readers, provenance and the completeness audit."""

import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripfold.functions.months import check_month

# Fixed names of the source's files and columns.
TRIP_FILE_PREFIX = "yellow_tripdata_"
ZONE_FILE = "taxi_zone_lookup.csv"
REQUIRED_TRIP_COLUMNS = (
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "PULocationID",
    "DOLocationID",
    "trip_distance",
    "fare_amount",
    "total_amount",
)
REQUIRED_ZONE_COLUMNS = ("LocationID", "Borough", "Zone", "service_zone")
PROVENANCE = ("source_month", "source_filename", "ingested_at", "ingestion_run_id")

PARQUET_MAGIC = b"PAR1"


def trip_filename(month: str) -> str:
    return f"{TRIP_FILE_PREFIX}{check_month(month)}.parquet"


def filename_column(month: Column) -> Column:
    """Column form of ``trip_filename``."""
    return F.concat(F.lit(TRIP_FILE_PREFIX), month, F.lit(".parquet"))


def require_columns(frame: DataFrame, required: tuple[str, ...]) -> None:
    """Case-sensitive contract on column names; extra columns are welcome."""
    missing = [name for name in required if name not in frame.columns]
    if missing:
        raise ValueError(f"source columns missing: {sorted(missing)}")


def read_trips(spark: SparkSession, path: str) -> DataFrame:
    """One month of trips with the file's own types."""
    frame = spark.read.parquet(path)
    require_columns(frame, REQUIRED_TRIP_COLUMNS)
    return frame


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """The zone lookup as text.  A malformed line fails whatever reads every column."""
    frame = spark.read.csv(path, header=True, mode="FAILFAST")
    require_columns(frame, REQUIRED_ZONE_COLUMNS)
    return frame


def with_provenance(frame: DataFrame, month: str, filename: str, run_id: str) -> DataFrame:
    return frame.withColumns(
        {
            "source_month": F.lit(check_month(month)),
            "source_filename": F.lit(filename),
            "ingested_at": F.current_timestamp(),
            "ingestion_run_id": F.lit(run_id),
        }
    )


def _listed(spark: SparkSession, folder: str, months: Sequence[str]) -> DataFrame:
    """The files below the months' folders, as Spark itself lists them: with the session's
    own file systems and settings, and without names that start with ``_`` or ``.``.

    Scans pass over empty files, so what is listed but not scanned has length 0.  The names
    come from the listing that the scan uses, which the driver holds in any case."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    try:
        scanned = reader.load(f"{folder}/{{{','.join(months)}}}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string, length bigint, content binary")
    below = "[0-9]{4}-[0-9]{2}/[^/]+(?:/.*)?"
    found = [re.search(f"/({below})$", unquote(path)).group(1) for path in scanned.inputFiles()]
    names = spark.createDataFrame([(path,) for path in found], "path string")
    files = scanned.select(
        F.regexp_extract("path", f"/({below})$", 1).alias("path"), "length", "content"
    )
    return names.join(files, "path", "left").select(
        "path", F.coalesce("length", F.lit(0)).alias("length"), "content"
    )


def landing_audit(
    spark: SparkSession, folder: str, months: Sequence[str], ends: bool = True
) -> DataFrame:
    """Completeness of the landing files of the given months, one row per file.

    ``violation`` is NULL for a sound file.  The folders are listed once.  With ``ends`` the
    files are read, each whole by one task, as their reader offers no part of them; without
    it nothing but the listing is, which finds missing and empty files and odd names."""
    months = sorted(set(map(check_month, months)))
    wanted = spark.createDataFrame([(month,) for month in months], "source_month string")
    pieces = F.split("path", "/", 2)
    listed = _listed(spark, folder.rstrip("/"), months).select(
        pieces[0].alias("source_month"),
        # A trip file may be a folder of part files.
        F.substring_index(pieces[1], "/", 1).alias("file_name"),
        pieces[1].alias("path"),
        "length",
        "content",
    )
    trip_file = filename_column(F.col("source_month"))
    name, content = F.col("file_name"), F.col("content")
    size = len(PARQUET_MAGIC)
    violation = (
        F.when(F.col("length") == 0, "empty_file")
        .when(~name.isin(ZONE_FILE) & (name != trip_file), "unexpected_name")
    )
    if ends:
        sound = (
            (F.col("length") >= 2 * size)
            & (F.substring(content, 1, size) == PARQUET_MAGIC)
            & (F.substring(content, -size, size) == PARQUET_MAGIC)
        )
        violation = violation.when((name == trip_file) & ~sound, "incomplete_parquet")
    audited = listed.select(
        "source_month", "file_name", "path", "length", violation.alias("violation")
    )
    expected = wanted.select(
        "source_month", F.explode(F.array(trip_file, F.lit(ZONE_FILE))).alias("file_name")
    )
    absent = expected.join(
        listed.select("source_month", "file_name"), ["source_month", "file_name"], "left_anti"
    ).withColumn("violation", F.lit("missing_file"))
    return audited.unionByName(absent, allowMissingColumns=True)
