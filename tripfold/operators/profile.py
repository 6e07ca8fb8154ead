"""Column profiles, exact duplicates and category frequencies."""

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField

from tripfold.functions.missing import is_missing, is_numeric
from tripfold.sources.landing import PROVENANCE

QUARTILES = [0.25, 0.5, 0.75]
ACCURACY = 10000


def of_tables(
    tables: Mapping[str, DataFrame], measure: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """The same measure of several tables under ``table_name``, each scanned once."""
    named = [
        measure(frame).select(F.lit(name).alias("table_name"), "*")
        for name, frame in tables.items()
    ]
    return reduce(DataFrame.unionByName, named)


def source_columns(frame: DataFrame) -> list[str]:
    """Columns that came with the source, not from ingestion."""
    return [name for name in frame.columns if name not in PROVENANCE]


def _column_metrics(field: StructField, with_distinct: bool):
    value = F.col(f"`{field.name}`")
    missing = is_missing(field)
    if is_numeric(field.dataType):
        quartiles = F.percentile_approx(F.when(~missing, value), QUARTILES, ACCURACY)
    else:
        quartiles = F.lit(None)
    metrics = [
        F.lit(field.name).alias("column_name"),
        F.lit(field.dataType.simpleString()).alias("data_type"),
        F.count("*").alias("total"),
        F.count_if(missing).alias("missing"),
        (100 * F.count_if(missing) / F.count("*")).alias("missing_pct"),
        F.min(value).cast("string").alias("min_value"),
        F.max(value).cast("string").alias("max_value"),
        quartiles.cast("array<double>").alias("quartiles"),
    ]
    if with_distinct:
        metrics.append(F.approx_count_distinct(value).alias("distinct_approx"))
    return F.struct(*metrics)


def column_profile(
    frame: DataFrame,
    by: str = "source_month",
    columns: Sequence[str] | None = None,
    with_distinct: bool = True,
) -> DataFrame:
    """One row per month and source column.

    All metrics of all columns come from a single aggregation: counts, extremes and
    sketches are merged map-side, so a task ships one row per month whatever its size."""
    columns = source_columns(frame) if columns is None else columns
    metrics = [_column_metrics(frame.schema[name], with_distinct) for name in columns]
    return (
        frame.groupBy(by).agg(F.array(*metrics).alias("metrics")).select(by, F.inline("metrics"))
    )


def distinct_counts(
    frame: DataFrame, by: str = "source_month", columns: Sequence[str] | None = None
) -> DataFrame:
    """Exact number of distinct values per month and source column, NULL left out.

    One shuffle of distinct values after a map-side merge; the sketch of
    ``column_profile`` is the cheap way, this one checks it."""
    columns = source_columns(frame) if columns is None else columns
    values = [F.col(f"`{name}`").cast("string").alias(name) for name in columns]
    return (
        frame.select(by, *values)
        .unpivot([by], list(columns), "column_name", "value")
        .groupBy(by, "column_name", "value")
        .agg(F.lit(1).alias("seen"))
        .groupBy(by, "column_name")
        .agg(F.count("value").alias("distinct_exact"))
    )


def duplicate_groups(
    frame: DataFrame, by: str = "source_month", columns: Sequence[str] | None = None
) -> DataFrame:
    """Groups of rows equal in all given columns; NULLs and NaNs equal themselves.

    Copies collapse map-side, so even a very large group reaches its reducer as one row per
    task.  Every distinct row is shuffled; ``duplicate_counts`` needs no row at all."""
    columns = source_columns(frame) if columns is None else columns
    return (
        frame.groupBy(by, *columns)
        .agg(F.count("*").alias("copies"))
        .where(F.col("copies") > 1)
    )


def duplicate_counts(
    frame: DataFrame, by: str = "source_month", columns: Sequence[str] | None = None
) -> DataFrame:
    """Number of duplicate groups and of rows beyond the first of each, in one read.

    Rows are told apart by two 64-bit hashes of their values and of which are NULL, as a
    hash alone passes over NULLs; of 10^12 different rows two share both with a chance of
    about 10^-15.  Only hashes are shuffled, after copies have collapsed map-side."""
    columns = source_columns(frame) if columns is None else columns
    values = [F.col(f"`{name}`") for name in columns]
    absent = [value.isNull() for value in values]
    hashed = frame.select(
        by,
        F.xxhash64(*values, *absent).alias("__one"),
        F.xxhash64(F.lit("other"), *absent, *values).alias("__other"),
    )
    groups = hashed.groupBy(by, "__one", "__other").agg(F.count("*").alias("copies"))
    return duplicate_excess(groups.where(F.col("copies") > 1), by)


def duplicate_excess(groups: DataFrame, by: str = "source_month") -> DataFrame:
    """Number of duplicate groups and of rows beyond the first of each."""
    return groups.groupBy(by).agg(
        F.count("*").alias("identical_groups"),
        F.sum(F.col("copies") - 1).alias("excess_identical_rows"),
    )


def category_counts(
    frame: DataFrame, columns: Sequence[str], by: str = "source_month"
) -> DataFrame:
    """Frequency of every value of every listed column, NULL included, in one scan.

    Columns the frame lacks are left out."""
    present = [name for name in columns if name in frame.columns]
    if not present:
        raise ValueError("the frame has none of the listed columns")
    values = [F.col(name).cast("string").alias(name) for name in present]
    return (
        frame.select(by, *values)
        .unpivot([by], present, "column_name", "value")
        .groupBy(by, "column_name", "value")
        .agg(F.count("*").alias("row_count"))
    )
