"""One row per series and step: the frame all models work on.

Source rows that share a step are folded into counts and sums before they
travel by series key, with map-side partial sums. After that a series has at
most as many rows as its calendar has steps, however many source rows it holds,
so everything partitioned by series is bounded. Least squares over the folded
rows equals least squares over the source rows.

Where the source is known to hold few rows per step, that bound is there from
the start: rows travel by series at once and are folded where they arrive, which
saves a shuffle of the whole table.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomcast.config import ForecastConfig
from loomcast.functions.steps import add_steps, ds_type, step_number


#: On resampled rows: false where a step was filled in and no source row stands behind it.
SOURCED = "_sourced"


def fold_steps(
    rows: DataFrame, keys: list[str], sums: Iterable[Column] = (), n_rows: Column | None = None
) -> DataFrame:
    if n_rows is None and SOURCED in rows.columns:
        n_rows = F.count_if(SOURCED)
    return rows.groupBy(*keys, "ds").agg(
        (F.count("*") if n_rows is None else n_rows).alias("n_rows"),
        F.count("y").alias("n_obs"),
        F.sum("y").alias("sum_y"),
        *sums,
    )


def series_steps(
    rows: DataFrame,
    cfg: ForecastConfig,
    sums: Iterable[Column] = (),
    n_rows: Column | None = None,
) -> DataFrame:
    """Folded steps partitioned by series, with ``last_ds`` and ``bad_date``.

    One exchange by series key serves the windows here and whatever the caller
    groups by series next. The quality filter applies when it is on.
    """
    if cfg.few_rows_per_step:
        steps = fold_steps(by_series(rows, cfg), cfg.keys, sums, n_rows)
    else:
        steps = fold_steps(rows, cfg.keys, sums, n_rows)
        if cfg.series_partitions:
            steps = by_series(steps, cfg)
    return _with_series_facts(steps, cfg)


def by_series(frame: DataFrame, cfg: ForecastConfig) -> DataFrame:
    """Partition by series.

    ``series_partitions`` fixes the number of tasks, which grouped maps need: their
    cost follows the number of series and not the bytes that adaptive execution
    goes by. Without it the tasks follow the bytes.
    """
    if cfg.series_partitions:
        return frame.repartition(cfg.series_partitions, *cfg.keys)
    return frame.repartition(*cfg.keys)


def tested_steps(rows: DataFrame, cfg: ForecastConfig) -> DataFrame:
    """Steps for a backtest whose training sums add up over source rows.

    With few rows per step the rows themselves serve, each as a step of its own
    that keeps its target ``y``; scoring then needs no second look at the source.
    """
    if not cfg.few_rows_per_step:
        return series_steps(rows, cfg)
    y = F.col("y")
    single = by_series(rows, cfg).select(
        *cfg.keys,
        "ds",
        "y",
        F.lit(1).cast("bigint").alias("n_rows"),
        y.isNotNull().cast("bigint").alias("n_obs"),
        y.alias("sum_y"),
    )
    return _with_series_facts(single, cfg)


def _with_series_facts(steps: DataFrame, cfg: ForecastConfig) -> DataFrame:
    keys = cfg.keys
    series = Window.partitionBy(*keys)
    facts = {
        "last_ds": F.max(F.when(F.col("n_rows") > 0, F.col("ds"))).over(series),
        "bad_date": F.max(F.col("ds").isNull() & (F.col("n_rows") > 0)).over(series),
    }
    if cfg.data_quality_check:
        total = F.sum("n_rows").over(series)
        facts["_ratio"] = (total - F.sum("n_obs").over(series)) / F.greatest(total, F.lit(1))
    steps = steps.withColumns(facts)
    if cfg.data_quality_check:
        steps = steps.where(F.col("_ratio") <= cfg.missing_threshold).drop("_ratio")
    return steps


def with_horizon(steps: DataFrame, cfg: ForecastConfig, blank: Iterable[str]) -> DataFrame:
    """Append the horizon to each series: ``h`` is 0 on history, 1.. on the horizon.

    The last step of a series expands in place, so no join and no exchange is
    needed. Columns in ``blank`` become null on the new rows.
    """
    blank = set(blank)
    is_last = F.col("ds").eqNullSafe(F.col("last_ds")) & F.col("ds").isNotNull()
    offsets = F.when(
        is_last, F.sequence(F.lit(0), F.lit(cfg.prediction_length))
    ).otherwise(F.array(F.lit(0)))
    grown = steps.withColumn("h", F.explode(offsets))
    on_horizon = F.col("h") > 0
    return grown.select(
        *[
            F.when(~on_horizon, F.col(c)).alias(c) if c in blank else F.col(c)
            for c in grown.columns
            if c != "ds"
        ],
        F.when(on_horizon, add_steps(F.col("last_ds"), F.col("h"), cfg.freq))
        .otherwise(F.col("ds"))
        .alias("ds"),
    )


def mean_target() -> Column:
    """Mean target of a folded step; null where it has none."""
    return F.try_divide("sum_y", "n_obs")


def error_row() -> Column:
    """The one row of a horizon-extended series that carries the error of the series."""
    return (F.col("h") == 1) | F.col("last_ds").isNull()


def wanted_rows(failed: Column, cfg: ForecastConfig) -> Column:
    """Forecast rows of a horizon-extended series, or the one row of a failed series."""
    asked = F.lit(True) if cfg.include_history else F.col("h") > 0
    return (~failed & asked) | (failed & error_row())


def future_grid(rows: DataFrame, cfg: ForecastConfig, include_history: bool = False) -> DataFrame:
    """Forecast dates per series: the horizon, and the history dates on request."""
    keys = cfg.keys
    if include_history:
        return with_horizon(series_steps(rows, cfg), cfg, ()).select(*keys, "h", "ds")
    last = rows.groupBy(*keys).agg(F.max("ds").alias("last_ds"))
    return explode_horizon(last, cfg).select(*keys, "h", "ds")


def explode_horizon(frame: DataFrame, cfg: ForecastConfig, last: str = "last_ds") -> DataFrame:
    """One row per step of the horizon that follows column ``last``."""
    steps = F.sequence(F.lit(1), F.lit(cfg.prediction_length))
    return frame.withColumn("h", F.explode(steps)).withColumn(
        "ds", add_steps(F.col(last), F.col("h"), cfg.freq)
    )


def resample_spine(rows: DataFrame, cfg: ForecastConfig) -> DataFrame:
    """One row per step from the first to the last date of a series.

    The target of a step is the sum of its rows, null where there are none.
    Gaps are filled from each row up to the next one, which needs neither a
    generated calendar nor a join. Other columns are averaged and null in gaps,
    apart from the bounds of logistic growth, which stay as they were. ``_sourced``
    tells the source's steps from those filled in. Rows without a date stay as
    one undated step of their series, so that the models still report them.
    """
    keys = cfg.keys
    extra = [c for c in rows.columns if c not in (*keys, "ds", "y")]
    steps = rows.groupBy(*keys, "ds").agg(
        F.sum("y").alias("y"), *[F.avg(c).alias(c) for c in extra]
    )
    # Nulls come first, so an undated step never ends a gap.
    following = F.lead("ds").over(Window.partitionBy(*keys).orderBy("ds"))
    gap = F.coalesce(
        step_number(F.col("_next"), cfg.freq) - step_number(F.col("ds"), cfg.freq), F.lit(1)
    ).cast("int")
    filled = steps.withColumn("_next", following).withColumn(
        "_i", F.explode(F.sequence(F.lit(0), F.greatest(gap, F.lit(1)) - 1))
    )
    return filled.select(
        *keys,
        F.when(F.col("_i") > 0, add_steps(F.col("ds"), F.col("_i"), cfg.freq))
        .otherwise(F.col("ds"))
        .cast(ds_type(cfg.freq))
        .alias("ds"),
        *[
            F.col(c) if c in (cfg.cap_col, cfg.floor_col) else F.when(F.col("_i") == 0, F.col(c)).alias(c)
            for c in ("y", *extra)
        ],
        (F.col("_i") == 0).alias(SOURCED),
    )
