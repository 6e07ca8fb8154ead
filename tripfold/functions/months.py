"""The month contract (``YYYY-MM``, a real month) for parameters and for columns."""

import re
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONTH_PATTERN = "[0-9]{4}-(0[1-9]|1[0-2])"


def check_month(value: str) -> str:
    """Return a month parameter unchanged, or refuse it.

    Months end up in partition specs and paths, so anything else is an error."""
    if not isinstance(value, str) or not re.fullmatch(MONTH_PATTERN, value):
        raise ValueError(f"not a YYYY-MM month: {value!r}")
    date.fromisoformat(f"{value}-01")
    return value


def parse_months(text: str) -> list[str]:
    """``"2026-02, 2026-01"`` -> ``["2026-01", "2026-02"]``; repeats are refused."""
    months = [check_month(part.strip()) for part in text.split(",")]
    if len(set(months)) < len(months):
        raise ValueError(f"repeated month in {text!r}")
    return sorted(months)


def is_month(text: Column) -> Column:
    """Column form of the contract: false for NULL, malformed or impossible months."""
    return F.coalesce(text.rlike(rf"\A{MONTH_PATTERN}\z") & ~text.startswith("0000"), F.lit(False))


def month_contract(frame: DataFrame, column: str) -> DataFrame:
    """Occurrences and validity of every distinct month text in a column.

    The texts are counted map-side first; validity is judged once per distinct text."""
    return (
        frame.groupBy(F.col(column).alias("month_text"))
        .agg(F.count("*").alias("row_count"))
        .withColumn("is_valid", is_month(F.col("month_text")))
    )


def month_of(moment: Column) -> Column:
    """Calendar month of a wall-clock timestamp.

    Goes through DATE so that the session zone can never move the month."""
    return F.date_format(moment.cast("date"), "yyyy-MM")
