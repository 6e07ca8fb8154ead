"""What counts as a missing value, by column type."""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DoubleType,
    FloatType,
    NumericType,
    StringType,
    StructField,
)


def is_numeric(data_type: DataType) -> bool:
    return isinstance(data_type, NumericType)


def is_missing(field: StructField) -> Column:
    """NULL; for text also blank after trimming; for floating point also NaN.

    Integers and decimals cannot hold NaN, so they get no NaN test."""
    value = F.col(f"`{field.name}`")
    if isinstance(field.dataType, StringType):
        return value.isNull() | (F.trim(value) == "")
    if isinstance(field.dataType, (DoubleType, FloatType)):
        return value.isNull() | F.isnan(value)
    return value.isNull()
