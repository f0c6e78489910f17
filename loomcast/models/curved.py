"""Forms that are not linear in their coefficients, fitted for all series at once."""

from __future__ import annotations

from abc import abstractmethod
from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomcast.config import ForecastConfig
from loomcast.functions.steps import clock
from loomcast.models.base import NativeModel
from loomcast.models.linear import BAD_DATE, INFINITE, TOO_FEW
from loomcast.operators.keys import null_safe_join
from loomcast.operators.newton import Form, Point, newton_fits
from loomcast.operators.quality import missing_ratio
from loomcast.operators.steps import SOURCED, explode_horizon, fold_steps
from loomcast.operators.windows import (
    actual_windows,
    backtest_cutoffs,
    prediction_columns,
    scored_dates,
    training_windows,
)

OUT_OF_BOUNDS = "target outside its bounds"
NO_BOUNDS = "missing or empty bounds"


class CurvedModel(NativeModel):
    """Rounds of ``newton_fits`` over folded steps; the plan reads them once and keeps them.

    Subclasses say what they read of a row, which facts of a series they need, and the
    value of a step at given coefficients. Time runs from 0 to 1 over the history of a
    series. Building the result runs jobs, as many as the slowest series needs rounds.
    """

    def __init__(self, params: Mapping[str, Any]):
        unknown = params.keys() - self.defaults.keys()
        if unknown:
            raise TypeError(f"{type(self).__name__} does not take {sorted(unknown)}")
        self.params = {**self.defaults, **params}

    defaults: Mapping[str, Any] = {}

    def inputs(self) -> dict[str, Any]:
        return {}

    def targets(self, rows: DataFrame, cfg: ForecastConfig) -> DataFrame:
        """Rows with ``y`` as the form fits it, and columns that ``facts`` read."""
        return rows

    def facts(self, cfg: ForecastConfig) -> list[Column]:
        """Further aggregates of a series."""
        return []

    def series_error(self) -> Column:
        """What is wrong with a series by its facts, apart from dates and counts."""
        return F.lit(None).cast("string")

    @abstractmethod
    def start(self) -> Column: ...

    @abstractmethod
    def form(self, u: Column, days: Column) -> Form:
        """The form over scaled time ``u`` and ``days``, the date in days."""

    @abstractmethod
    def value(self, u: Column, days: Column) -> Column:
        """The target at coefficients ``solution``."""

    def forecast(self, rows: DataFrame, cfg: ForecastConfig) -> DataFrame:
        fits = self._fits(rows, cfg.keys, cfg)
        failed = F.col("error").isNotNull()
        grid = explode_horizon(fits, cfg).where(~failed | (F.col("h") == 1))
        if cfg.include_history:
            past = rows.select(*cfg.keys, "ds").distinct()
            alive = null_safe_join(past, fits.where(~failed), cfg.keys)
            grid = grid.unionByName(alive.withColumn("h", F.lit(0)))
        u, days = _time(cfg)
        return grid.select(
            *cfg.keys,
            F.when(~failed, F.col("ds")).alias("ds"),
            F.when(~failed, self.value(u, days)).alias("y_pred"),
            "error",
        )

    def backtest(self, rows: DataFrame, cfg: ForecastConfig) -> DataFrame:
        """Every window is a series of its own, so the rows are copied once per window
        that trains on them; all windows of all series settle side by side."""
        known = rows.where(F.col("ds").isNotNull())
        if SOURCED in known.columns:
            known = known.where(SOURCED)
        cutoffs = backtest_cutoffs(known, cfg)
        keys = [*cfg.keys, "cutoff"]
        fits = self._fits(training_windows(known, cutoffs, cfg), keys, cfg)
        tested = actual_windows(fold_steps(known, cfg.keys), cutoffs, cfg).groupBy(*keys).agg(
            F.sum("n_rows").alias("_n_actual"), F.min("ds").alias("first_actual")
        )
        tested = tested.where(F.col("_n_actual") >= cfg.prediction_length)
        windows = null_safe_join(fits.withColumnRenamed("last_ds", "last_train"), tested, keys)
        dates = scored_dates(windows, cfg)
        u, days = _time(cfg)
        failed = F.col("error").isNotNull()
        predicted = dates.withColumn("y_pred", F.when(~failed, self.value(u, days)))
        return predicted.select(*prediction_columns(dates, cfg))

    def _fits(self, rows: DataFrame, keys: list[str], cfg: ForecastConfig) -> DataFrame:
        """Keys, ``solution``, ``first_t``, ``span``, ``last_ds``, facts and ``error``."""
        rows = self.targets(rows, cfg)
        t = clock(F.col("ds"), cfg.freq).cast("double")
        counted = F.count_if(SOURCED) if SOURCED in rows.columns else F.count("*")
        known = F.col("y").isNotNull()
        facts = rows.groupBy(*keys).agg(
            F.min(F.when(known, t)).alias("first_t"),
            F.max(F.when(known, t)).alias("last_t"),
            F.max("ds").alias("last_ds"),
            F.max(F.col("ds").isNull()).alias("bad_date"),
            F.avg("y").alias("mean_y"),
            F.sum(F.abs("y")).alias("size_y"),
            F.count("y").alias("n_obs"),
            counted.alias("n_rows"),
            *self.facts(cfg),
        )
        if cfg.data_quality_check:
            ratio = missing_ratio(F.col("n_rows") - F.col("n_obs"), F.col("n_rows"))
            facts = facts.where(ratio <= cfg.missing_threshold)
        error = (
            F.when(F.col("bad_date"), F.lit(BAD_DATE))
            .when(F.isnan(F.col("size_y") - F.col("size_y")), INFINITE)
            .otherwise(self.series_error())
        )
        error = F.coalesce(
            error, F.when((F.col("n_obs") < 2) | (F.col("first_t") >= F.col("last_t")), TOO_FEW)
        )
        facts = facts.withColumns(
            {"span": F.col("last_t") - F.col("first_t"), "error": error}
        ).drop("n_obs", "n_rows", "bad_date", "last_t", "size_y").checkpoint()
        sound = facts.where("error is null")
        steps = fold_steps(rows, keys).select(*keys, "ds", "n_obs", "sum_y")
        times = sound.select(*keys, "first_t", "span")
        # Only sound series travel on.
        placed = null_safe_join(steps.where("n_obs > 0"), times, keys)
        u, days = _time(cfg)
        placed = placed.select(*keys, "n_obs", "sum_y", u.alias("_u"), days.alias("_days"))
        start = sound.drop("error").withColumn("solution", self.start())
        fitted = newton_fits(placed, keys, start, self.form(F.col("_u"), F.col("_days")))
        return fitted.unionByName(facts.where("error is not null"), allowMissingColumns=True)


class LogisticTrend(CurvedModel):
    """``floor + (cap - floor) * sigmoid(level + slope * time)`` by fractional logit.

    The targets themselves are fitted, by the likelihood of a share, and not their
    logits: targets at the floor or the cap are ordinary data, and a series of zeros
    gives a fit near zero. The loss is convex. Columns ``cap`` and, optionally,
    ``floor`` hold the bounds; the last ones of a series hold for its horizon and the
    history is predicted with the same. A target outside its bounds, a missing bound,
    or a cap not above its floor fails the series.
    """

    def inputs(self) -> dict[str, Any]:
        return {"logistic": True}

    def targets(self, rows: DataFrame, cfg: ForecastConfig) -> DataFrame:
        y, cap, floor = F.col("y"), F.col(cfg.cap_col), F.col(cfg.floor_col)
        bounded = cap.isNotNull() & floor.isNotNull() & (cap > floor)
        outside = (y < floor) | (y > cap)
        return rows.withColumns(
            {
                "_cap": cap.cast("double"),
                "_floor": floor.cast("double"),
                "_unbounded": ~bounded,
                "_outside": F.coalesce(outside & ~F.isnan(y), F.lit(False)),
                "y": F.when(bounded, (y - floor) / (cap - floor)),
            }
        )

    def facts(self, cfg: ForecastConfig) -> list[Column]:
        last = F.struct("_cap", "_floor")
        return [
            F.max_by(last, F.struct("ds", "_cap", "_floor")).alias("bounds"),
            F.max("_unbounded").alias("unbounded"),
            F.max("_outside").alias("outside"),
        ]

    def series_error(self) -> Column:
        return F.when(F.col("unbounded"), F.lit(NO_BOUNDS)).when(F.col("outside"), OUT_OF_BOUNDS)

    def start(self) -> Column:
        return F.array(F.lit(0.0), F.lit(0.0))

    def form(self, u: Column, days: Column) -> Form:
        def at(beta: Column) -> Point:
            line = F.get(beta, 0) + F.get(beta, 1) * u
            share = _sigmoid(line)
            loss = F.log1p(F.exp(-F.abs(line))) + F.greatest(line, F.lit(0.0))
            return Point(
                share, [F.lit(1.0), u], share * (1 - share),
                F.col("n_obs") * loss - F.col("sum_y") * line,
                F.col("n_obs").cast("double"),
            )

        return at

    def value(self, u: Column, days: Column) -> Column:
        share = _sigmoid(F.get("solution", 0) + F.get("solution", 1) * u)
        return F.col("bounds._floor") + (F.col("bounds._cap") - F.col("bounds._floor")) * share


class MultiplicativeSeason(CurvedModel):
    """``(level + slope * time) * (1 + season)``, least squares, no priors.

    The season is ``order`` harmonics of ``period`` days. All coefficients move
    together. A series of zeros gives zeros.
    """

    defaults = {"period": 7.0, "order": 3}

    def start(self) -> Column:
        zeros = [F.lit(0.0)] * (1 + 2 * int(self.params["order"]))
        return F.array(F.coalesce("mean_y", F.lit(0.0)), *zeros)

    def _waves(self, days: Column) -> list[Column]:
        angle = 2 * F.pi() * days / F.lit(float(self.params["period"]))
        orders = range(1, int(self.params["order"]) + 1)
        return [wave(F.lit(float(m)) * angle) for wave in (F.sin, F.cos) for m in orders]

    def _parts(self, beta: Column, u: Column, waves: list[Column]) -> tuple[Column, Column]:
        season = F.lit(1.0)
        for i, wave in enumerate(waves, 2):
            season += F.get(beta, i) * wave
        return F.get(beta, 0) + F.get(beta, 1) * u, season

    def form(self, u: Column, days: Column) -> Form:
        waves = self._waves(days)

        def at(beta: Column) -> Point:
            trend, season = self._parts(beta, u, waves)
            fitted = trend * season
            return Point(
                fitted, [season, u * season, *[trend * wave for wave in waves]], F.lit(1.0),
                fitted * (F.col("n_obs") * fitted - 2 * F.col("sum_y")),
                F.abs("sum_y") + F.col("n_obs") * F.abs(fitted),
            )

        return at

    def value(self, u: Column, days: Column) -> Column:
        trend, season = self._parts(F.col("solution"), u, self._waves(days))
        return trend * season


def _sigmoid(value: Column) -> Column:
    return 1 / (1 + F.exp(-value))


def _time(cfg: ForecastConfig) -> tuple[Column, Column]:
    t = clock(F.col("ds"), cfg.freq).cast("double")
    return (t - F.col("first_t")) / F.col("span"), t / 24 if cfg.freq == "H" else t
