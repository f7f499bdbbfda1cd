"""Typed columns, optional columns and rounding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Sums of DECIMAL(18,2); the ten extra digits are what Spark adds for a sum.
MONEY = T.DecimalType(28, 2)


def typed_null(data_type: str | T.DataType) -> Column:
    """A NULL of the type that the other branch of a union has."""
    return F.lit(None).cast(data_type)


def optional_column(
    df: DataFrame, name: str, data_type: str | T.DataType, *, lenient: bool = False
) -> Column:
    """The column if the table has it, else a typed NULL. Text that does not fit the type raises
    unless ``lenient``. The schema is known before any row is read, so no row is turned into JSON."""
    if name not in df.columns:
        return typed_null(data_type)
    return F.col(name).try_cast(data_type) if lenient else F.col(name).cast(data_type)


def money(value: Column) -> Column:
    """Two digits, halves away from zero, as DECIMAL(28,2). Exact on DECIMAL input."""
    return F.round(value, 2).cast(MONEY)


def hours_from_minutes(minutes: Column) -> Column:
    """Whole minutes as hours with two digits. Minutes are summed as integers and divided once."""
    return F.round(minutes.cast("decimal(28,0)") / 60, 2).cast(MONEY)


def json_value(text: Column, path: str, data_type: str | T.DataType = "string") -> Column:
    """A scalar out of JSON text, NULL if the path is missing."""
    return F.get_json_object(text, path).cast(data_type)
