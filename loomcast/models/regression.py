"""Trend, seasons, holidays and regressors without priors: least squares by moments."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomcast.config import ForecastConfig
from loomcast.functions.steps import clock
from loomcast.models.base import NativeModel, SeriesModel
from loomcast.models.decomposable import FOURIER, Decomposable
from loomcast.models.linear import BAD_DATE, INFINITE
from loomcast.operators.keys import null_safe_join
from loomcast.operators.moments import (
    design_moments,
    even_knots,
    fourier_moments,
    hinge_moments,
    with_solution,
)
from loomcast.operators.quality import missing_ratio
from loomcast.operators.steps import SOURCED, explode_horizon
from loomcast.sources.tables import read_source

TOO_FEW_ROWS = "fewer than two usable rows"
SINGULAR_DESIGN = "singular design"
NO_FUTURE = "missing regressor value on a forecast date"

#: The sums of a design grow with the square of its columns; wider ones go per series.
MAX_COLUMNS = 40


class MomentRegression(NativeModel):
    """The linear, additive form without priors and changepoints, for all series at once.

    Built from a ``Decomposable`` of that form. ``forecast`` reads the holiday calendar
    and the future regressors that ``bind`` was given.
    """

    def __init__(self, params: Mapping[str, Any]):
        self.seasons = [
            (period, FOURIER[name][1] if wanted is True else int(wanted))
            for name, (period, _) in FOURIER.items()
            if (wanted := params.get(f"{name}_seasonality"))
        ]
        self.regressors = tuple(params.get("regressors") or ())
        self.holidays = params.get("holidays")
        self.calendar: DataFrame | None = None
        self.names: list[str] = []
        self.future: DataFrame | None = None

    def inputs(self) -> dict[str, Any]:
        return {"regressors": self.regressors}

    def bind(self, calendar: DataFrame | None, names: list[str], future: DataFrame | None):
        self.calendar, self.names, self.future = calendar, names, future
        return self

    @property
    def width(self) -> int:
        return 2 + 2 * sum(k for _, k in self.seasons) + len(self.names) + len(self.regressors)

    def forecast(self, rows: DataFrame, cfg: ForecastConfig) -> DataFrame:
        rows = rows.select(
            *cfg.keys, "ds", "y", *self.regressors, *([SOURCED] if SOURCED in rows.columns else [])
        )
        counted = F.count_if(SOURCED) if SOURCED in rows.columns else F.count("*")
        facts = [
            F.max("ds").alias("last_ds"),
            F.max(F.col("ds").isNull()).alias("bad_date"),
            counted.alias("n_rows"),
        ]
        flagged = self._with_holidays(rows)
        if len(self.seasons) == 1 and not self.names and not self.regressors:
            period, order = self.seasons[0]
            moments = fourier_moments(flagged, cfg.keys, _days(cfg), period, order, facts)
            lost = []
        else:
            columns = {"one": F.lit(1.0), "t": _days(cfg), **self._effects(cfg)}
            moments = design_moments(flagged, cfg.keys, columns, "t", facts)
            lost = [(r, F.get("lost", len(columns) - len(self.regressors) + i))
                    for i, r in enumerate(self.regressors)]
        if cfg.data_quality_check:
            ratio = missing_ratio(F.col("n_rows") - F.col("n_obs"), F.col("n_rows"))
            moments = moments.where(ratio <= cfg.missing_threshold)
        solved = with_solution(moments)
        error = F.when(F.col("bad_date"), F.lit(BAD_DATE)).when(F.col("n_obs") < 2, TOO_FEW_ROWS)
        error = error.when(F.isnan(F.col("sum_yy") - F.col("sum_yy")), INFINITE)
        for name, count in lost:
            error = error.when(count > 0, f"missing value in regressor {name}")
        error = error.when(F.col("solution").isNull(), SINGULAR_DESIGN)
        fits = solved.select(*cfg.keys, "solution", "origin", "last_ds", error.alias("error"))
        return self._predicted(fits, rows, cfg)

    def _predicted(self, fits: DataFrame, rows: DataFrame, cfg: ForecastConfig) -> DataFrame:
        grid = explode_horizon(fits, cfg)
        if self.regressors:
            values = self.future.groupBy(*cfg.keys, "ds").agg(
                *[F.avg(r).alias(r) for r in self.regressors]
            )
            grid = null_safe_join(grid, values, cfg.keys, ["ds"], "left")
            known = F.lit(True)
            for r in self.regressors:
                known &= F.col(r).isNotNull()
            lacking = F.max(~known).over(Window.partitionBy(*cfg.keys))
            grid = grid.withColumn("error", F.coalesce("error", F.when(lacking, F.lit(NO_FUTURE))))
        failed = F.col("error").isNotNull()
        grid = grid.where(~failed | (F.col("h") == 1))
        if cfg.include_history:
            past = rows.groupBy(*cfg.keys, "ds").agg(*[F.avg(r).alias(r) for r in self.regressors]) \
                if self.regressors else rows.select(*cfg.keys, "ds").distinct()
            # A failed series keeps the one row of its horizon.
            alive = grid.where("h = 1").where(~failed).select(
                *cfg.keys, "solution", "origin", "last_ds", "error"
            )
            grid = grid.unionByName(
                null_safe_join(past, alive, cfg.keys).withColumn("h", F.lit(0)),
                allowMissingColumns=True,
            )
        grid = self._with_holidays(grid)
        value = F.get("solution", 0) + F.get("solution", 1) * (_days(cfg) - F.col("origin"))
        for i, effect in enumerate(self._effects(cfg).values(), 2):
            value += F.get("solution", i) * effect
        return grid.select(
            *cfg.keys,
            F.when(~failed, F.col("ds")).alias("ds"),
            F.when(~failed, value).alias("y_pred"),
            "error",
        )

    def backtest(self, rows: DataFrame, cfg: ForecastConfig) -> DataFrame:
        raise NotImplementedError("backtests of this form run per series")

    def _effects(self, cfg: ForecastConfig) -> dict[str, Column]:
        out = {}
        for period, order in self.seasons:
            for f, wave in (("s", F.sin), ("c", F.cos)):
                for m in range(1, order + 1):
                    angle = F.lit(2 * m) * F.pi() * _days(cfg) / F.lit(period)
                    out[f"{f}{m} {period}"] = wave(angle)
        for name in self.names:
            present = F.array_contains("_holidays", name)
            out[f"holiday {name}"] = F.coalesce(present, F.lit(False)).cast("double")
        return {**out, **{f"regressor {r}": F.col(r).cast("double") for r in self.regressors}}

    def _with_holidays(self, frame: DataFrame) -> DataFrame:
        if not self.names:
            return frame
        on_day = F.col("ds").cast("date") == F.col("_day")
        return frame.join(self.calendar, on_day, "left")


def _days(cfg: ForecastConfig) -> Column:
    days = clock(F.col("ds"), cfg.freq).cast("double")
    return days / 24 if cfg.freq == "H" else days


def moment_form(model: NativeModel | SeriesModel) -> MomentRegression | None:
    """The same fit as aggregates, where a model has that form: linear, additive, no
    priors, no changepoints, seasons given and not found."""
    if type(model) is not Decomposable:
        return None
    p = model.p
    fixed = all(getattr(p, f"{name}_seasonality") != "auto" for name in FOURIER)
    priors = (p.trend_prior_scale, p.seasonality_prior_scale, p.holidays_prior_scale,
              p.regressors_prior_scale)
    if p.growth != "linear" or p.seasonality_mode != "additive" or p.n_changepoints or not fixed:
        return None
    return None if any(priors) else MomentRegression(model.params)


def bound_moment_form(
    model: NativeModel | SeriesModel, spark, fmt: str = "parquet"
) -> MomentRegression | None:
    """``moment_form`` with its holiday calendar; null too where the design is too wide."""
    form = moment_form(model)
    if form is None:
        return None
    if form.holidays is not None:
        source = read_source(spark, form.holidays, fmt).select("holiday", F.col("ds").cast("date"))
        # Names become columns: as many as a design may have, or one more to tell.
        names = source.select("holiday").where("holiday is not null").distinct()
        names = [row.holiday for row in names.limit(MAX_COLUMNS + 1).collect()]
        calendar = source.groupBy(F.col("ds").alias("_day")).agg(
            F.collect_set("holiday").alias("_holidays")
        )
        form.bind(calendar, sorted(names), None)
    return form if form.width <= MAX_COLUMNS else None


def changepoint_trend(
    rows: DataFrame, cfg: ForecastConfig, count: int, share: float = 0.8
) -> DataFrame:
    """Horizon of a line that may bend at ``count`` evenly spaced dates, by least squares.

    Keys, ``ds``, ``y_pred``, ``error``: a series without enough dates around its knots
    is singular and keeps one row with its error.
    """
    t = clock(F.col("ds"), cfg.freq).cast("double")
    series = Window.partitionBy(*cfg.keys)
    bounded = rows.withColumns({"_first": F.min(t).over(series), "_last": F.max(t).over(series)})
    # Counted from the first date of the series.
    knots = even_knots(F.lit(0.0), F.col("_last") - F.col("_first"), count, share)
    facts = [
        F.max("_first").alias("origin"),
        F.max("ds").alias("last_ds"),
        F.max(F.col("ds").isNull()).alias("bad_date"),
    ]
    moments = hinge_moments(bounded, cfg.keys, t - F.col("_first"), knots, facts)
    solved = with_solution(moments)
    error = (
        F.when(F.col("bad_date"), F.lit(BAD_DATE))
        .when(F.col("n_obs") < 2, TOO_FEW_ROWS)
        .when(F.isnan(F.col("sum_yy") - F.col("sum_yy")), INFINITE)
        .when(F.col("solution").isNull(), SINGULAR_DESIGN)
    )
    fits = solved.select(*cfg.keys, "solution", "origin", "knots", "last_ds", error.alias("error"))
    failed = F.col("error").isNotNull()
    grid = explode_horizon(fits, cfg).where(~failed | (F.col("h") == 1))
    at = grid.withColumn("_at", t - F.col("origin"))
    bends = F.aggregate(
        F.zip_with(
            "knots",
            F.slice("solution", F.lit(3), F.size("knots")),
            lambda s, c: c * F.greatest(F.col("_at") - s, F.lit(0.0)),
        ),
        F.lit(0.0),
        lambda total, part: total + part,
    )
    value = F.get("solution", 0) + F.get("solution", 1) * F.col("_at") + bends
    return at.select(
        *cfg.keys,
        F.when(~failed, F.col("ds")).alias("ds"),
        F.when(~failed, value).alias("y_pred"),
        "error",
    )
