"""Seasonal baselines: the last value, or the mean, of the same phase."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomcast.config import ForecastConfig
from loomcast.functions.steps import step_number
from loomcast.models.base import NativeModel
from loomcast.models.linear import BAD_DATE
from loomcast.operators.keys import null_safe_join
from loomcast.operators.quality import missing_ratio
from loomcast.operators.steps import (
    by_series,
    explode_horizon,
    fold_steps,
    mean_target,
    series_steps,
    tested_steps,
    wanted_rows,
    with_horizon,
)
from loomcast.operators.windows import (
    fill_forward,
    first_training_window,
    prediction_columns,
    running_windows,
    scored_dates,
    with_window_index,
)

# Steps in one season by frequency: a week, a year, a year, a day.
DEFAULT_PERIOD = {"D": 7, "W": 52, "M": 12, "H": 24}
NO_TARGET = "no usable target"


class _PhaseModel(NativeModel):
    def __init__(self, params: Mapping[str, Any]):
        params = dict(params)
        self.period = params.pop("period", None)
        if params:
            raise TypeError(f"unknown parameters {sorted(params)}")

    def _phase(self, ds: Column, cfg: ForecastConfig) -> Column:
        period = self.period or DEFAULT_PERIOD[cfg.freq]
        return F.pmod(step_number(ds, cfg.freq), F.lit(period)).cast("int")

    def _fitted(self, phase: Window) -> Column:
        """Value for each row from the rows of its phase."""
        raise NotImplementedError

    def _phase_values(self, rows: DataFrame, cfg: ForecastConfig) -> DataFrame:
        """One row per series and phase: its ``value`` and what the series needs to know."""
        raise NotImplementedError

    def _window_values(self, steps: DataFrame, by: list[str]) -> DataFrame:
        """Running value of each (series, phase) after each window's new steps."""
        raise NotImplementedError

    def forecast(self, rows: DataFrame, cfg: ForecastConfig) -> DataFrame:
        if cfg.include_history:
            return self.forecast_over_steps(rows, cfg)
        return self._horizon_only(rows, cfg)

    def _horizon_only(self, rows: DataFrame, cfg: ForecastConfig) -> DataFrame:
        """A map from phase to value per series; history rows go no further than that."""
        keys = cfg.keys
        usable = F.when(
            F.col("phase").isNotNull() & F.col("value").isNotNull(), F.struct("phase", "value")
        )
        series = self._phase_values(rows, cfg).groupBy(*keys).agg(
            F.map_from_entries(F.collect_list(usable)).alias("values"),
            F.max("last_ds").alias("last_ds"),
            F.max("bad_date").alias("bad_date"),
            F.sum("n_rows").alias("n_rows"),
            F.sum("n_obs").alias("n_obs"),
        )
        if cfg.data_quality_check:
            ratio = missing_ratio(F.col("n_rows") - F.col("n_obs"), F.col("n_rows"))
            series = series.where(ratio <= cfg.missing_threshold)
        series = series.withColumn("error", _error(F.col("bad_date"), F.col("n_obs")))
        failed = F.col("error").isNotNull()
        grid = explode_horizon(series, cfg).where(~failed | (F.col("h") == 1))
        return grid.select(
            *keys,
            F.when(~failed, F.col("ds")).alias("ds"),
            F.when(~failed, F.try_element_at("values", self._phase(F.col("ds"), cfg))).alias(
                "y_pred"
            ),
            "error",
        )

    def forecast_over_steps(self, rows: DataFrame, cfg: ForecastConfig) -> DataFrame:
        keys = cfg.keys
        steps = series_steps(rows, cfg)
        steps = steps.withColumn("_usable", F.sum("n_obs").over(Window.partitionBy(*keys)))
        grid = with_horizon(steps, cfg, ("n_obs", "sum_y"))
        grid = grid.withColumn("phase", self._phase(F.col("ds"), cfg))
        phase = Window.partitionBy(*keys, "phase").orderBy("ds")
        grid = grid.withColumns(
            {
                "y_pred": self._fitted(phase),
                "error": _error(F.col("bad_date"), F.col("_usable")),
            }
        )
        failed = F.col("error").isNotNull()
        return grid.where(wanted_rows(failed, cfg)).select(
            *keys,
            F.when(~failed, F.col("ds")).alias("ds"),
            F.when(~failed, F.col("y_pred")).alias("y_pred"),
            "error",
        )

    def backtest(self, rows: DataFrame, cfg: ForecastConfig) -> DataFrame:
        keys = cfg.keys
        steps = series_steps(rows, cfg).where(F.col("ds").isNotNull())
        windows = running_windows(tested_steps(rows, cfg), cfg).withColumn(
            "error", F.when(F.col("train_obs") == 0, F.lit(NO_TARGET))
        )
        by = [*keys, "last_k", "phase"]
        indexed = (
            with_window_index(steps.where(F.col("n_obs") > 0), cfg)
            .withColumn("k", first_training_window(F.col("i"), cfg))
            .where(F.col("k") <= F.col("last_k"))
            .withColumn("phase", self._phase(F.col("ds"), cfg))
        )
        values = fill_forward(self._window_values(indexed, by), by).select(
            *keys, "phase", "k", F.col("value").alias("y_pred")
        )
        dates = scored_dates(windows, cfg).withColumn("phase", self._phase(F.col("ds"), cfg))
        return null_safe_join(dates, values, keys, ["phase", "k"], "left").select(
            *prediction_columns(dates, cfg)
        )


def _error(bad_date: Column, n_obs: Column) -> Column:
    return F.when(bad_date, F.lit(BAD_DATE)).when(n_obs == 0, F.lit(NO_TARGET))


def _by_phase(
    frame: DataFrame,
    cfg: ForecastConfig,
    phase: Column,
    value: Column,
    n_rows: Column,
    n_obs: Column,
) -> DataFrame:
    return frame.groupBy(*cfg.keys, phase.alias("phase")).agg(
        value.alias("value"),
        n_rows.alias("n_rows"),
        n_obs.alias("n_obs"),
        F.max("ds").alias("last_ds"),
        F.max(F.col("ds").isNull()).alias("bad_date"),
    )


class SeasonalNaive(_PhaseModel):
    """The last value seen one or more whole seasons earlier."""

    def _fitted(self, phase):
        before = phase.rowsBetween(Window.unboundedPreceding, -1)
        return F.last(mean_target(), ignorenulls=True).over(before)

    def _phase_values(self, rows, cfg):
        if cfg.few_rows_per_step:
            rows = by_series(rows, cfg)
        steps = fold_steps(rows, cfg.keys)
        return _by_phase(
            steps,
            cfg,
            self._phase(F.col("ds"), cfg),
            F.max_by(mean_target(), F.when(F.col("n_obs") > 0, F.col("ds"))),
            F.sum("n_rows"),
            F.sum("n_obs"),
        )

    def _window_values(self, steps, by):
        return steps.groupBy(*by, "k").agg(F.max_by(mean_target(), F.col("ds")).alias("value"))


class WeekdayProfile(_PhaseModel):
    """The mean over all steps of the same phase."""

    def _fitted(self, phase):
        whole = phase.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        return F.try_divide(F.sum("sum_y").over(whole), F.sum("n_obs").over(whole))

    def _phase_values(self, rows, cfg):
        phase = self._phase(F.col("ds"), cfg)
        return _by_phase(rows, cfg, phase, F.avg("y"), F.count("*"), F.count("y"))

    def _window_values(self, steps, by):
        so_far = Window.partitionBy(*by).orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
        sums = steps.groupBy(*by, "k").agg(
            F.sum("sum_y").alias("sum_y"), F.sum("n_obs").alias("n_obs")
        )
        return sums.withColumn("value", F.sum("sum_y").over(so_far) / F.sum("n_obs").over(so_far))
