"""Missing values. Missing means null or NaN; past the source only null is left."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def nan_to_null(value: Column) -> Column:
    number = value.cast("double")
    return F.when(~F.isnan(number), number)


def is_missing(value: Column) -> Column:
    return value.isNull() | F.isnan(value.cast("double"))


def coerce_number(value: Column) -> Column:
    """Number, with null for what does not parse."""
    return nan_to_null(value.try_cast("double"))


def zero_filled(value: Column) -> Column:
    return F.coalesce(nan_to_null(value), F.lit(0.0))
