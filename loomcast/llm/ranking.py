"""Positions in a total order without one task that sees all rows.

Rows fall into buckets by the leading part of an evenly spread sort value. A
bucket's first position is a running sum over the small table of bucket counts;
inside a bucket a window numbers the rows. The number of buckets grows with the
square root of the rows, so neither side has a task that grows with the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

MAX_BUCKETS = 1 << 20


def bucket_count(n_rows: int) -> int:
    return max(1, min(MAX_BUCKETS, int(n_rows**0.5)))


def hex_bucket(digest: Column, n_buckets: int) -> Column:
    """Bucket of a hexadecimal digest; order-preserving on its first 7 digits."""
    value = F.conv(F.substring(digest, 1, 7), 16, 10).cast("long")
    return F.floor(value * n_buckets / F.lit(float(16**7))).cast("long")


def running_totals(
    rows: DataFrame, groups: list[str], bucket: str, weight: Column, total: str
) -> DataFrame:
    """(groups, bucket, total): sum of the weight over the group's earlier buckets."""
    sums = rows.groupBy(*groups, bucket).agg(F.sum(weight).alias("_sum"))
    window = Window.partitionBy(*groups).orderBy(bucket)
    return sums.select(
        *groups, bucket, (F.sum("_sum").over(window) - F.col("_sum")).alias(total)
    )


def with_running_total(
    rows: DataFrame,
    groups: list[str],
    bucket: str,
    order: list[Column],
    weight: Column,
    name: str,
) -> DataFrame:
    """Adds ``name``: the weight of all rows of the group before this one, exclusive.

    ``groups`` must not be null. ``weight`` of 1 gives positions from 0.
    """
    before = running_totals(rows, groups, bucket, weight, "_before")
    inside = Window.partitionBy(*groups, bucket).orderBy(*order)
    own = F.sum(weight).over(inside.rowsBetween(Window.unboundedPreceding, 0)) - weight
    return (
        rows.withColumn("_own", own)
        .join(before, [*groups, bucket])
        .withColumn(name, F.col("_before") + F.col("_own"))
        .drop("_before", "_own")
    )
