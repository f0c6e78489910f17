"""Reading tables, paths and frames."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession


def quote_name(name: str) -> str:
    """Backtick every part of a dotted table name; leave a quoted name alone."""
    if "`" in name:
        return name
    return ".".join(f"`{part}`" for part in name.split("."))


def is_path(name: str) -> bool:
    return "/" in name or name.endswith(".parquet")


def read_source(spark: SparkSession, source: Any, fmt: str = "parquet") -> DataFrame:
    """A DataFrame as it is, a path through ``fmt``, anything else from the catalog."""
    if isinstance(source, DataFrame):
        return source
    if not source:
        raise ValueError("no source configured")
    if is_path(source):
        return spark.read.format(fmt).load(source)
    return spark.read.table(quote_name(source))


def scan_sql(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"SELECT * FROM {quote_name(name)}")


def preview(df: DataFrame, n: int = 5, order_by: tuple[str, ...] = ()) -> DataFrame:
    """First ``n`` rows; deterministic when ordered."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def row_count(df: DataFrame) -> DataFrame:
    return df.groupBy().count().withColumnRenamed("count", "n_rows")
