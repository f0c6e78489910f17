"""Small frames, and the backtest written as plain loops."""

import datetime as dt

import numpy as np
import pandas as pd

from loomcast import ForecastConfig, SeriesModel

EPOCH = dt.date(2024, 1, 1)


def config(**changes):
    base = dict(
        prediction_length=7,
        backtest_length=30,
        stride=7,
        active_models=("LinearTrend",),
        models={
            "LinearTrend": {},
            "SeasonalNaive": {},
            "WeekdayProfile": {},
            "Decomposable": {},
        },
    )
    return ForecastConfig(**{**base, **changes})


def sales(spark, rows, extra=""):
    """Rows of (store, item, date or timestamp, target, ...)."""
    kind = "timestamp_ntz" if isinstance(rows[0][2], dt.datetime) else "date"
    schema = f"store_nbr int, item_nbr int, date {kind}, unit_sales double"
    return spark.createDataFrame(rows, schema + (f", {extra}" if extra else ""))


def daily(store, item, values, start=EPOCH):
    return [(store, item, start + dt.timedelta(days=i), v) for i, v in enumerate(values)]


OFFSETS = {
    "D": lambda n: pd.DateOffset(days=n),
    "W": lambda n: pd.DateOffset(weeks=n),
    "H": lambda n: pd.DateOffset(hours=n),
    "M": lambda n: pd.offsets.MonthEnd(n),
}


def looped_backtest(frame, cfg, predict):
    """Windows of one series as a loop over dates: {cutoff: smape or inf}.

    ``frame`` has ``ds`` and ``y``, one row per source row.
    ``predict(train, dates)`` returns predictions or raises.
    """
    step = OFFSETS[cfg.freq]
    frame = frame.sort_values("ds")
    last = frame["ds"].max()
    cutoff = last
    for _ in range(cfg.backtest_length - 1):
        cutoff = cutoff - step(1)
    if cfg.backtest_start is not None:
        cutoff = pd.Timestamp(cfg.backtest_start)
        cutoff = cutoff + pd.offsets.MonthEnd(0) if cfg.freq == "M" else cutoff
    out = {}
    while cutoff + step(cfg.prediction_length) <= last + step(1):
        end = cutoff + step(cfg.prediction_length)
        train = frame[frame["ds"] < cutoff]
        actual = frame[(frame["ds"] >= cutoff) & (frame["ds"] < end)]
        if len(train) and len(actual) >= cfg.prediction_length:
            grid, at = [], train["ds"].max()
            for _ in range(cfg.prediction_length):
                at = at + step(1)
                grid.append(at)
            try:
                values = dict(zip(grid, predict(train, grid)))
                y = actual["y"][actual["ds"].isin(grid)].fillna(0).to_numpy()
                p = np.array([values[d] for d in actual["ds"] if d in values])
                if len(y):
                    p = np.nan_to_num(p)
                    size = np.abs(y) + np.abs(p)
                    terms = np.where(size == 0, 0, 2 * np.abs(y - p) / np.where(size == 0, 1, size))
                    out[cutoff] = terms.mean()
            except ValueError:
                out[cutoff] = np.inf
        cutoff = cutoff + step(cfg.stride)
    return out


def line(train, dates):
    train = train.dropna()
    if train["ds"].nunique() < 2:
        raise ValueError("too few")
    origin = train["ds"].min()
    days = lambda ds: np.array([(d - origin) / pd.Timedelta(days=1) for d in ds])
    slope, intercept = np.polyfit(days(train["ds"]), train["y"].to_numpy(), 1)
    return intercept + slope * days(dates)


def naive(period, unit):
    """Last mean value at the same phase; steps counted in ``unit`` since 1970."""

    def predict(train, dates):
        train = train.dropna()
        if train.empty:
            raise ValueError("no target")
        means = train.groupby("ds")["y"].mean()
        phase = lambda d: unit(d) % period
        out = []
        for date in dates:
            same = [v for d, v in means.items() if phase(d) == phase(date)]
            out.append(same[-1] if same else np.nan)
        return np.array(out)

    return predict


class Failing(SeriesModel):
    def fit(self, history):
        raise RuntimeError("always")

    def forecast(self, dates):
        return dates


class Shapeless(SeriesModel):
    def fit(self, history):
        return self

    def forecast(self, dates):
        return dates[["ds"]]


class MeanOf(SeriesModel):
    def fit(self, history):
        self.level = history["sum_y"].sum() / history["n_obs"].sum()
        return self

    def forecast(self, dates):
        return pd.DataFrame({"ds": dates["ds"], "y_pred": self.level})
