"""Series profile and the missing-target filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomcast.operators.keys import null_safe_join


def series_profile(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows, missing targets and date range per series; one shuffle of partial sums."""
    return rows.groupBy(*keys).agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("y").isNull()).alias("n_missing"),
        F.min("ds").alias("first_ds"),
        F.max("ds").alias("last_ds"),
    )


def missing_ratio(n_missing: Column, n_rows: Column) -> Column:
    return n_missing / n_rows


def removed_series(profile: DataFrame, keys: list[str], threshold: float) -> DataFrame:
    """Series whose missing ratio is above the threshold; exactly at it is kept."""
    ratio = missing_ratio(F.col("n_missing"), F.col("n_rows"))
    return profile.where(ratio > threshold).select(
        *keys, "n_rows", "n_missing", ratio.alias("missing_ratio")
    )


def kept_series(profile: DataFrame, threshold: float) -> DataFrame:
    return profile.where(missing_ratio(F.col("n_missing"), F.col("n_rows")) <= threshold)


def require_survivors(profile: DataFrame, threshold: float) -> None:
    if kept_series(profile, threshold).isEmpty():
        raise ValueError("no series passed the data quality check")


def kept_rows(rows: DataFrame, keys: list[str], threshold: float) -> DataFrame:
    """Rows of the series that pass the missing-target filter.

    The rows meet the *removed* keys, the smaller set, in an anti join. Spark
    broadcasts the keys when their measured size is under its threshold, and
    splits the rows of a large series over several tasks otherwise.
    """
    removed = removed_series(series_profile(rows, keys), keys, threshold).select(*keys)
    return null_safe_join(rows, removed, keys, how="left_anti")


def global_last_date(rows: DataFrame) -> DataFrame:
    return rows.groupBy().agg(F.max("ds").alias("last_ds"))
