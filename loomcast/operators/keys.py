"""Series keys and the narrow row frame every job starts from.

A *row frame* holds the key columns, ``ds``, ``y`` and whatever a model asks
for, one row per source row.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcast.config import ForecastConfig
from loomcast.functions.missing import nan_to_null
from loomcast.functions.steps import to_step


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")


def with_series_key(df: DataFrame, store_id: str, item_id: str, group_id: str) -> DataFrame:
    """Add ``store_item`` as one string. Null parts are left out; never null."""
    require_columns(df, (store_id, item_id))
    return df.withColumn(
        group_id, F.concat_ws("_", F.col(store_id).cast("string"), F.col(item_id).cast("string"))
    )


def series_rows(df: DataFrame, cfg: ForecastConfig, extra: Iterable[str] = ()) -> DataFrame:
    """Project a source table to a row frame.

    The projection comes before any grouped map, which would hide unused columns
    from the optimizer; with it the scan reads only what is named here.
    """
    extra = list(dict.fromkeys(extra))
    require_columns(df, [cfg.store_id, cfg.item_id, cfg.date_col, cfg.target, *extra])
    keyed = with_series_key(df, cfg.store_id, cfg.item_id, cfg.group_id)
    return keyed.select(
        *cfg.keys,
        to_step(F.col(cfg.date_col), cfg.freq).alias("ds"),
        nan_to_null(F.col(cfg.target)).alias("y"),
        *[nan_to_null(F.col(name)).alias(name) for name in extra],
    )


def null_safe_join(
    left: DataFrame, right: DataFrame, keys: list[str], on: Iterable[str] = (), how: str = "inner"
) -> DataFrame:
    """Join on series keys, whose parts may be null, and on plain columns ``on``."""
    names = [*keys, *on]
    if len(keys) == 1:
        return left.join(right, names, how)
    right = right.withColumnsRenamed({name: f"_right_{name}" for name in names})
    condition = F.lit(True)
    for name in keys:
        condition &= F.col(name).eqNullSafe(F.col(f"_right_{name}"))
    for name in on:
        condition &= F.col(name) == F.col(f"_right_{name}")
    return left.join(right, condition, how).drop(*[f"_right_{name}" for name in names])
