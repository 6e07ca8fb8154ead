"""Wall-clock durations that do not depend on the session time zone."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def wall_seconds(start: Column, end: Column) -> Column:
    """Whole seconds between two TIMESTAMP_NTZ values, truncated toward zero.

    ``timestampdiff`` would first cast both to the session zone and lose or gain an
    hour around a clock change; subtracting NTZ values never leaves the wall clock."""
    return (end - start).cast("interval second").cast("bigint")


def wall_minutes(start: Column, end: Column) -> Column:
    """Minutes as decimal(27,6): whole seconds over an exact decimal 60.0."""
    return wall_seconds(start, end) / F.expr("60.0")
