"""Rolling-origin windows.

Window ``k`` of a series starts at cutoff ``first + k * stride`` and tests the
``prediction_length`` steps from there; it trains on everything before. The
first cutoff lies ``backtest_length`` steps before the end of the series, or at
``backtest_start`` for all series; the last window is the last one that its
series has the dates for.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomcast.config import ForecastConfig
from loomcast.functions.missing import zero_filled
from loomcast.functions.steps import add_steps, elapsed, step_index, to_step
from loomcast.operators.keys import null_safe_join


def first_cutoff(last: Column, cfg: ForecastConfig) -> Column:
    if cfg.backtest_start is not None:
        given = to_step(F.lit(str(cfg.backtest_start)), cfg.freq)
        return F.when(last.isNotNull(), given)
    return add_steps(last, 1 - cfg.backtest_length, cfg.freq)


def last_window(last: Column, first: Column, cfg: ForecastConfig) -> Column:
    """Number of the last window; negative where the series ends before the first one does."""
    if cfg.backtest_start is None:
        return F.lit(cfg.window_count - 1)
    room = step_index(last, first, cfg.freq) + 1 - cfg.prediction_length
    return F.coalesce(F.floor(room / cfg.stride).cast("int"), F.lit(-1))


def cutoff_at(first: Column, k: Column, cfg: ForecastConfig) -> Column:
    return add_steps(first, k * cfg.stride, cfg.freq)


def backtest_cutoffs(rows: DataFrame, cfg: ForecastConfig) -> DataFrame:
    """Every window of every series: keys, ``k``, ``cutoff``, ``test_end``."""
    last = rows.groupBy(*cfg.keys).agg(F.max("ds").alias("last_ds"))
    first = first_cutoff(F.col("last_ds"), cfg)
    upto = last_window(F.col("last_ds"), first, cfg)
    windows = last.withColumn(
        "k", F.explode(F.when(upto >= 0, F.sequence(F.lit(0), upto)))
    ).withColumn("cutoff", cutoff_at(first, F.col("k"), cfg))
    end = add_steps(F.col("cutoff"), cfg.prediction_length, cfg.freq)
    return windows.select(*cfg.keys, "k", "cutoff", end.alias("test_end"))


def training_windows(steps: DataFrame, cutoffs: DataFrame, cfg: ForecastConfig) -> DataFrame:
    """Steps strictly before each cutoff. Copies a series once per window."""
    joined = null_safe_join(steps, cutoffs.select(*cfg.keys, "cutoff"), cfg.keys)
    return joined.where(F.col("ds") < F.col("cutoff"))


def actual_windows(steps: DataFrame, cutoffs: DataFrame, cfg: ForecastConfig) -> DataFrame:
    """Steps with ``cutoff <= ds < test_end``."""
    joined = null_safe_join(steps, cutoffs.select(*cfg.keys, "cutoff", "test_end"), cfg.keys)
    return joined.where((F.col("ds") >= F.col("cutoff")) & (F.col("ds") < F.col("test_end")))


def with_window_index(steps: DataFrame, cfg: ForecastConfig) -> DataFrame:
    """Add the first cutoff of the series, its ``last_k``, and ``i``, the whole steps from
    the cutoff to ``ds``."""
    steps = steps.withColumn("first_cutoff", first_cutoff(F.col("last_ds"), cfg))
    upto = last_window(F.col("last_ds"), F.col("first_cutoff"), cfg)
    steps = steps.withColumn("last_k", upto)
    return steps.withColumn("i", step_index(F.col("ds"), F.col("first_cutoff"), cfg.freq))


def first_training_window(i: Column, cfg: ForecastConfig) -> Column:
    """First window whose cutoff lies strictly after index ``i``."""
    return F.greatest(F.lit(0), F.floor(i / cfg.stride) + 1).cast("int")


def running_windows(
    steps: DataFrame, cfg: ForecastConfig, sums: Mapping[str, Column] | None = None
) -> DataFrame:
    """Windows that can be scored, each with running sums over its training steps.

    Each step becomes one training entry, at the first window that sees it, and
    one test entry per window it is tested in. A sum per (series, window) and a
    running sum over the windows then give every expanding training set without
    copying the series per window. All of it keeps the partitioning by series.

    Windows without training rows, or with fewer test rows than the horizon, are
    left out. Result: keys, ``k``, ``cutoff``, ``first_cutoff``, ``last_train``,
    ``train_obs`` and the running ``sums``. From folded steps there is one row per
    window, with ``first_actual``. From steps that still hold their target there is
    one row per window and distinct test row, with ``ds``, ``y`` and the number of
    such rows as ``weight``.
    """
    keys = cfg.keys
    steps = with_window_index(steps.where(F.col("ds").isNotNull()), cfg)
    sums = {"train_rows": F.col("n_rows"), "train_obs": F.col("n_obs"), **(sums or {})}
    entries = (
        steps.withColumns({f"_sum_{name}": value for name, value in sums.items()})
        .withColumn("_entry", F.explode(_entries(F.col("i"), F.col("last_k"), cfg)))
        .withColumns({"k": F.shiftright("_entry", 1), "train": F.col("_entry") % 2 == 1})
    )
    train = F.col("train")
    with_target = "y" in steps.columns
    by = [*keys, "first_cutoff", "k"]
    if with_target:
        tested = {"ds": F.col("ds"), "y": zero_filled(F.col("y"))}
        by += ["train", *[F.when(~train, v).alias(f"_test_{name}") for name, v in tested.items()]]
    per_window = entries.groupBy(*by).agg(
        *[F.sum(F.when(train, F.col(f"_sum_{name}"))).alias(name) for name in sums],
        F.max(F.when(train, F.col("ds"))).alias("last_train"),
        F.min(F.when(~train & (F.col("n_rows") > 0), F.col("ds"))).alias("first_actual"),
        F.sum(F.when(~train, F.col("n_rows"))).alias("weight"),
    )
    window = Window.partitionBy(*keys, "k").orderBy("k")
    whole = window.rangeBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    so_far = Window.partitionBy(*keys).orderBy("k").rangeBetween(Window.unboundedPreceding, 0)
    running = per_window.withColumns(
        {
            **{name: F.sum(name).over(so_far) for name in sums},
            "last_train": F.max("last_train").over(so_far),
            "_n_actual": F.sum("weight").over(whole),
        }
    )
    running = running.where(
        (F.col("train_rows") > 0) & (F.col("_n_actual") >= cfg.prediction_length)
    ).withColumn("cutoff", cutoff_at(F.col("first_cutoff"), F.col("k"), cfg))
    if not with_target:
        return running.drop("_n_actual", "train_rows", "weight")
    return (
        running.where(~train)
        .withColumnsRenamed({"_test_ds": "ds", "_test_y": "y"})
        .drop("_n_actual", "train_rows", "train", "first_actual")
    )


def _entries(i: Column, last_k: Column, cfg: ForecastConfig) -> Column:
    """Codes of the windows a step at index ``i`` enters.

    ``2 * k`` is a test of window ``k`` and ``2 * k + 1`` the start of training in
    it. Plain numbers keep the expansion in generated code.
    """
    start = first_training_window(i, cfg)
    low = F.greatest(F.lit(0), F.ceil((i - cfg.prediction_length + 1) / cfg.stride)).cast("int")
    high = F.least(last_k, F.floor(i / cfg.stride)).cast("int")
    none = F.array().cast("array<int>")
    return F.concat(
        F.when(start <= last_k, F.array(2 * start + 1)).otherwise(none),
        F.when(low <= high, F.sequence(2 * low, 2 * high, F.lit(2))).otherwise(none),
    )


def scored_dates(windows: DataFrame, cfg: ForecastConfig) -> DataFrame:
    """Forecast dates of each window that fall into its test range.

    The grid follows the last training step; with a gap before the cutoff it
    covers only part of the test range. A window with an ``error`` gets one row,
    on its first test date, so that scoring meets it there.

    Windows that come with their test rows keep those that lie on the grid, or
    all of them in a failed window.
    """
    failed = F.col("error").isNotNull()
    if "y" in windows.columns:
        ahead = steps_ahead(F.col("ds"), F.col("last_train"), cfg)
        return windows.where(failed | ahead.between(1, cfg.prediction_length))
    offsets = F.when(failed, F.array(F.lit(0))).otherwise(
        F.sequence(F.lit(1), F.lit(cfg.prediction_length))
    )
    ds = F.when(failed, F.col("first_actual")).otherwise(
        add_steps(F.col("last_train"), F.col("h"), cfg.freq)
    )
    grid = windows.withColumn("h", F.explode(offsets)).withColumn("ds", ds)
    return grid.where(F.col("ds") >= F.col("cutoff"))


def steps_ahead(ds: Column, last: Column, cfg: ForecastConfig) -> Column:
    """Steps of the grid after ``last`` at ``ds``; 0 for a date off the grid."""
    ahead = step_index(ds, last, cfg.freq)
    if cfg.freq == "W":
        return F.when(elapsed(ds, last, "D") % 7 == 0, ahead).otherwise(0)
    return ahead


def prediction_columns(dates: DataFrame, cfg: ForecastConfig) -> list[str]:
    actual = [c for c in ("y", "weight") if c in dates.columns]
    return [*cfg.keys, "cutoff", "ds", "y_pred", "error", *actual]


def fill_forward(stats: DataFrame, by: Iterable[str]) -> DataFrame:
    """Repeat each window's running values in the windows up to the next one present.

    The last ones hold up to ``last_k``.
    """
    following = F.lead("k").over(Window.partitionBy(*by).orderBy("k"))
    upto = F.coalesce(F.col("_next") - 1, F.col("last_k"))
    return (
        stats.withColumn("_next", following)
        .withColumn("k", F.explode(F.sequence(F.col("k"), upto)))
        .drop("_next")
    )
