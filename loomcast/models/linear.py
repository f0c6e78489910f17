"""Straight-line trend per series, in closed form."""

from __future__ import annotations

from collections.abc import Mapping
from statistics import NormalDist
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomcast.config import ForecastConfig
from loomcast.functions.steps import elapsed
from loomcast.models.base import NativeModel
from loomcast.operators.quality import missing_ratio
from loomcast.operators.steps import (
    explode_horizon,
    series_steps,
    tested_steps,
    wanted_rows,
    with_horizon,
)
from loomcast.operators.windows import prediction_columns, running_windows, scored_dates

TOO_FEW = "fewer than two usable dates"
BAD_DATE = "missing date"
INFINITE = "infinite target"


class LinearTrend(NativeModel):
    """Ordinary least squares of the target on time.

    With ``interval_width``, a share between 0 and 1, forecasts carry ``y_lower`` and
    ``y_upper``: the range of a new target at that date under normal errors, from the
    spread of the source rows around the line. It is null below three targets.
    """

    def __init__(self, params: Mapping[str, Any]):
        unknown = params.keys() - {"interval_width"}
        if unknown:
            raise TypeError(f"LinearTrend takes interval_width only, got {sorted(unknown)}")
        width = params.get("interval_width")
        if width is not None and not 0 < width < 1:
            raise ValueError("interval_width must lie between 0 and 1")
        self.reach = NormalDist().inv_cdf((1 + width) / 2) if width else None

    def _bounds(self, failed: Column, value: Column, half: Column) -> list[Column]:
        if self.reach is None:
            return []
        half = F.lit(self.reach) * half
        return [
            F.when(~failed, value - half).alias("y_lower"),
            F.when(~failed, value + half).alias("y_upper"),
        ]

    def forecast(self, rows: DataFrame, cfg: ForecastConfig) -> DataFrame:
        if cfg.include_history:
            return self.forecast_over_steps(rows, cfg)
        return self._horizon_only(rows, cfg)

    def _horizon_only(self, rows: DataFrame, cfg: ForecastConfig) -> DataFrame:
        """One aggregation by series: only its partial states are shuffled."""
        t = elapsed(F.col("ds"), _epoch(cfg), cfg.freq)
        fits = rows.groupBy(*cfg.keys).agg(
            F.regr_slope("y", t).alias("slope"),
            F.regr_intercept("y", t).alias("intercept"),
            F.max("ds").alias("last_ds"),
            F.max(F.col("ds").isNull()).alias("bad_date"),
            F.count("*").alias("n_rows"),
            F.count("y").alias("n_obs"),
            *(
                [
                    F.regr_syy("y", t).alias("syy"),
                    F.regr_sxx("y", t).alias("sxx"),
                    F.regr_avgx("y", t).alias("mean_t"),
                ]
                if self.reach
                else []
            ),
        )
        if cfg.data_quality_check:
            ratio = missing_ratio(F.col("n_rows") - F.col("n_obs"), F.col("n_rows"))
            fits = fits.where(ratio <= cfg.missing_threshold)
        fits = fits.withColumn("error", _error(F.col("bad_date"), F.col("slope")))
        failed = F.col("error").isNotNull()
        # A failed series keeps one row, which carries its error.
        grid = explode_horizon(fits, cfg).where(~failed | (F.col("h") == 1))
        y_pred = F.col("intercept") + F.col("slope") * t
        rest = F.col("syy") - F.col("slope") * F.col("slope") * F.col("sxx")
        half = _half(F.col("n_obs"), rest, F.col("sxx"), t - F.col("mean_t"))
        return grid.select(
            *cfg.keys,
            F.when(~failed, F.col("ds")).alias("ds"),
            F.when(~failed, y_pred).alias("y_pred"),
            "error",
            *self._bounds(failed, y_pred, half),
        )

    def forecast_over_steps(self, rows: DataFrame, cfg: ForecastConfig) -> DataFrame:
        squares = [F.sum(F.col("y") * F.col("y")).alias("sum_yy")] if self.reach else []
        steps = series_steps(rows, cfg, squares)
        t = elapsed(F.col("ds"), F.col("last_ds"), cfg.freq)
        series = Window.partitionBy(*cfg.keys)
        totals = {name: F.sum(value).over(series) for name, value in _sums(t).items()}
        slope, intercept = _line(**{name: F.col(f"_{name}") for name in totals})
        if self.reach:
            totals["syy"] = F.sum("sum_yy").over(series)
        fitted = steps.withColumns({f"_{name}": value for name, value in totals.items()})
        fitted = fitted.withColumns({"_slope": slope, "_intercept": intercept})
        fitted = fitted.withColumn("error", _error(F.col("bad_date"), F.col("_slope")))
        failed = F.col("error").isNotNull()
        grid = with_horizon(fitted, cfg, ()).where(wanted_rows(failed, cfg))
        y_pred = F.col("_intercept") + F.col("_slope") * t
        n = F.col("_n")
        sxx = F.col("_stt") - F.col("_st") * F.col("_st") / n
        rest = F.col("_syy") - F.col("_sy") * F.col("_sy") / n - F.col("_slope") ** 2 * sxx
        half = _half(n, rest, sxx, t - F.col("_st") / n)
        return grid.select(
            *cfg.keys,
            F.when(~failed, F.col("ds")).alias("ds"),
            F.when(~failed, y_pred).alias("y_pred"),
            "error",
            *self._bounds(failed, y_pred, half),
        )

    def backtest(self, rows: DataFrame, cfg: ForecastConfig) -> DataFrame:
        steps = tested_steps(rows, cfg)
        t = elapsed(F.col("ds"), F.col("first_cutoff"), cfg.freq)
        windows = running_windows(steps, cfg, _sums(t))
        slope, intercept = _line(**{name: F.col(name) for name in _sums(t)})
        fitted = windows.withColumns({"slope": slope, "intercept": intercept})
        fitted = fitted.withColumn("error", _error(F.lit(False), F.col("slope")))
        dates = scored_dates(fitted, cfg)
        y_pred = F.col("intercept") + F.col("slope") * t
        return dates.withColumn("y_pred", y_pred).select(*prediction_columns(dates, cfg))


def _epoch(cfg: ForecastConfig) -> Column:
    return F.lit("1970-01-01").cast("timestamp_ntz" if cfg.freq == "H" else "date")


def _sums(t: Column) -> dict[str, Column]:
    """Sums over folded steps from which a line can be fitted."""
    n, t = F.col("n_obs").cast("double"), t.cast("double")
    return {
        "n": n,
        "st": n * t,
        "stt": n * t * t,
        "sy": F.coalesce("sum_y", F.lit(0.0)),
        "sty": t * F.coalesce("sum_y", F.lit(0.0)),
    }


def _line(n: Column, st: Column, stt: Column, sy: Column, sty: Column) -> tuple[Column, Column]:
    """Slope and intercept; null unless there are two distinct dates."""
    spread = n * stt - st * st
    slope = F.when(spread > 0, (n * sty - st * sy) / spread)
    return slope, F.when(spread > 0, (sy - slope * st) / n)


def _half(n: Column, rest: Column, sxx: Column, distance: Column) -> Column:
    """Standard error of a new target ``distance`` from the mean date; ``rest`` is the sum
    of squared residuals."""
    variance = F.when(n > 2, F.greatest(rest, F.lit(0.0)) / (n - 2))
    return F.sqrt(variance * (1 + 1 / n + distance * distance / sxx))


def _error(bad_date: Column, slope: Column) -> Column:
    return (
        F.when(bad_date, F.lit(BAD_DATE))
        .when(slope.isNull(), F.lit(TOO_FEW))
        .when(F.isnan(slope - slope), F.lit(INFINITE))
    )
