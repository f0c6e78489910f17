"""Trend, seasonality, holidays and regressors, fitted per series.

The model form is that of Taylor and Letham, "Forecasting at Scale" (2018), with
their published defaults. Coefficients come from penalised least squares with
numpy: the Laplace prior on trend changes becomes a reweighted ridge, and the
multiplicative form is solved by Gauss-Newton steps. This approximates the
maximum a posteriori fit of the paper; it is not number for number the same.

All sums run over folded steps, so a step with a million source rows costs the
same as a step with one.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

import numpy as np
import pandas as pd

from loomcast.models.base import SeriesModel, holiday_column

# Published defaults of the model: Fourier orders and periods in days.
FOURIER = {"yearly": (365.25, 10), "weekly": (7.0, 3), "daily": (1.0, 4)}
TREND_PRIOR_SCALE = 5.0

BLOCK_ROWS = 65_536
MAX_ROUNDS = 500
REWEIGHTS = 8


class FitError(ValueError):
    """The series cannot be fitted."""


@dataclass(frozen=True)
class Parameters:
    growth: str = "linear"
    seasonality_mode: str = "additive"
    changepoint_prior_scale: float = 0.05
    n_changepoints: int = 25
    changepoint_range: float = 0.8
    yearly_seasonality: bool | int | str = "auto"
    weekly_seasonality: bool | int | str = "auto"
    daily_seasonality: bool | int | str = "auto"
    seasonality_prior_scale: float | None = 10.0
    holidays: Any = None
    holidays_prior_scale: float | None = 10.0
    regressors: tuple[str, ...] = ()
    regressors_prior_scale: float | None = 10.0
    trend_prior_scale: float | None = TREND_PRIOR_SCALE
    interval_width: float = 0.8  # accepted; the output has no interval columns

    def __post_init__(self):
        object.__setattr__(self, "regressors", tuple(self.regressors or ()))
        if self.growth not in ("linear", "logistic"):
            raise ValueError(f"unknown growth {self.growth!r}")
        if self.seasonality_mode not in ("additive", "multiplicative"):
            raise ValueError(f"unknown seasonality_mode {self.seasonality_mode!r}")
        if not 0 < self.interval_width < 1:
            raise ValueError("interval_width must lie between 0 and 1")
        if not 0 < self.changepoint_range <= 1:
            raise ValueError("changepoint_range must lie in (0, 1]")


class Decomposable(SeriesModel):
    def __init__(self, params: Mapping[str, Any]):
        super().__init__(params)
        self.p = Parameters(**self.params)

    def inputs(self) -> dict[str, Any]:
        return {
            "logistic": self.p.growth == "logistic",
            "regressors": self.p.regressors,
            "holidays": self.p.holidays,
        }

    def worker_copy(self, label: str) -> Decomposable:
        """Where the calendar was, the copy has the name of the joined column."""
        column = None if self.p.holidays is None else holiday_column(label)
        return Decomposable({**self.params, "holidays": column})

    def fit(self, history: pd.DataFrame) -> Decomposable:
        rows = history[history["n_obs"] > 0]
        n = rows["n_obs"].to_numpy(float)
        if n.sum() < 2:
            raise FitError("fewer than two usable rows")
        if not np.isfinite(rows["max_abs"]).all():
            raise FitError("infinite target")
        days = _days(rows["ds"])
        self.start, self.span = days[0], (days[-1] - days[0]) or 1.0
        self.fourier = self._seasonal_terms(days)
        self.holiday_names = _names(rows.get(self.p.holidays))
        self.changes = self._changepoints(days, n)

        design = _Design(self, rows)
        scale = rows["max_abs"].max() or 1.0
        sums = _Sums.of(rows, self.p.regressors, scale)
        if self.p.growth == "linear":
            mode = self.p.seasonality_mode
            trend, effects = _fit_jointly(design, sums, self._penalties(), mode)
        else:
            trend, effects = self._fit_logistic(rows, design, sums, scale)
        self.scale, self.trend, self.effects = scale, trend, effects
        return self

    def _fit_logistic(self, rows, design, sums, scale):
        """Trend on the logit scale, then effects on the scale of the target."""
        if (rows["n_z"] < rows["n_obs"]).any():
            raise FitError("targets must lie between floor and cap")
        z_scale = max(rows["max_abs_z"].max(), 1.0)
        on_logit = _Sums.of(rows, self.p.regressors, z_scale, "z")
        trend, _ = _fit_jointly(design, on_logit, self._penalties(), "additive")
        trend = trend * z_scale
        if not design.width:
            return trend, np.zeros(0)
        floor = rows["floor"].to_numpy(float) / scale
        room = rows["cap"].to_numpy(float) / scale - floor
        level = room * _sigmoid(design.trend_values(trend))
        effects = _fit_effects(
            design, sums, self._penalties(), self.p.seasonality_mode, level, floor
        )
        return trend, effects

    def forecast(self, dates: pd.DataFrame) -> pd.DataFrame:
        design = _Design(self, dates)
        level = design.trend_values(self.trend)
        effect = design.effect_values(self.effects)
        # An effect without coefficients leaves the trend alone.
        if self.p.growth == "logistic":
            floor = self.floor / self.scale
            level = (self.cap / self.scale - floor) * _sigmoid(level)
        else:
            floor = 0.0
        shape = level * effect if self.p.seasonality_mode == "multiplicative" else effect
        return pd.DataFrame(
            {"ds": dates["ds"].to_numpy(), "y_pred": (floor + level + shape) * self.scale}
        )

    def prepare_data(self, history: pd.DataFrame) -> pd.DataFrame:
        if self.p.growth == "logistic":
            # The last row's bounds hold for every forecast date, null included.
            self.cap, self.floor = history["cap"].iloc[-1], history["floor"].iloc[-1]
        for i, name in enumerate(self.p.regressors):
            if (history[f"nr_{name}"] < history["n_obs"]).any():
                raise FitError(f"missing value in regressor {name}")
        return history

    def _seasonal_terms(self, days: np.ndarray) -> list[tuple[float, int]]:
        distinct = np.unique(days)
        span = distinct[-1] - distinct[0]
        gap = np.diff(distinct).min() if len(distinct) > 1 else np.inf
        automatic = {
            "yearly": span >= 730,
            "weekly": span >= 14 and gap < 7,
            "daily": span >= 2 and gap < 1,
        }
        terms = []
        for name, (period, order) in FOURIER.items():
            wanted = getattr(self.p, f"{name}_seasonality")
            if wanted == "auto":
                wanted = bool(automatic[name])
            if wanted is True:
                terms.append((period, order))
            elif wanted:
                terms.append((period, int(wanted)))
        return terms

    def _changepoints(self, days: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Dates of evenly spaced source rows in the first part of the history."""
        early = int(np.floor(n.sum() * self.p.changepoint_range))
        count = min(self.p.n_changepoints, early - 1)
        if count < 1:
            return np.zeros(0)
        row = np.linspace(0, early - 1, count + 1).round()[1:]
        return np.unique(days[np.searchsorted(np.cumsum(n), row, side="right")])

    def _penalties(self) -> _Penalties:
        fourier = 2 * sum(order for _, order in self.fourier)
        scales = (
            [self.p.seasonality_prior_scale] * fourier
            + [self.p.holidays_prior_scale] * len(self.holiday_names)
            + [self.p.regressors_prior_scale] * len(self.p.regressors)
        )
        return _Penalties(
            trend=_precision([self.p.trend_prior_scale] * 2),
            change_scale=self.p.changepoint_prior_scale,
            effects=_precision(scales),
        )


@dataclass
class _Penalties:
    trend: np.ndarray
    change_scale: float
    effects: np.ndarray


@dataclass
class _Sums:
    """Per-step sums of the target and the regressors, scaled."""

    n: np.ndarray
    y: np.ndarray
    yy: np.ndarray
    r: np.ndarray  # steps x regressors
    rr: np.ndarray  # steps x regressors x regressors
    ry: np.ndarray  # steps x regressors

    @classmethod
    def of(cls, rows, regressors, scale, target="y") -> _Sums:
        take = lambda name: rows[name].to_numpy(float)
        stack = lambda prefix: np.stack(
            [take(f"{prefix}_{name}") for name in regressors] or [np.zeros(len(rows))], axis=1
        )[:, : len(regressors)]
        p = len(regressors)
        rr = np.zeros((len(rows), p, p))
        for i, a in enumerate(regressors):
            for j, b in enumerate(regressors[i:], i):
                pair = f"rr_{a}_{b}" if f"rr_{a}_{b}" in rows else f"rr_{b}_{a}"
                rr[:, i, j] = rr[:, j, i] = take(pair)
        return cls(
            n=take("n_obs"),
            y=take(f"sum_{target}") / scale,
            yy=take(f"sum_{target}{target}") / scale**2,
            r=stack("r"),
            rr=rr,
            ry=stack(f"r{target}") / scale,
        )

    def part(self, rows: slice) -> _Sums:
        return _Sums(*(value[rows] for value in vars(self).values()))


class _Design:
    """Design columns of a list of dates, made in blocks of bounded size."""

    def __init__(self, model: Decomposable, rows: pd.DataFrame):
        self.days = _days(rows["ds"])
        self.t = (self.days - model.start) / model.span
        self.knots = (model.changes - model.start) / model.span
        self.fourier = model.fourier
        self.names = model.holiday_names
        self.holidays = rows[model.p.holidays].to_numpy() if self.names else None
        self.regressors = np.stack(
            [rows[f"rm_{name}"].to_numpy(float) for name in model.p.regressors]
            or [np.zeros(len(rows))],
            axis=1,
        )[:, : len(model.p.regressors)]
        self.fixed_width = 2 * sum(order for _, order in self.fourier) + len(self.names)
        self.width = self.fixed_width + self.regressors.shape[1]
        self._kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def blocks(self):
        """Pairs of row slice and (trend, effect) columns; small inputs keep theirs."""
        for low in range(0, len(self.t), BLOCK_ROWS):
            rows = slice(low, low + BLOCK_ROWS)
            block = self._kept.get(low) or (self._trend(rows), self._effects(rows))
            if len(self.t) <= BLOCK_ROWS:
                self._kept[low] = block
            yield rows, *block

    def _trend(self, rows: slice) -> np.ndarray:
        t = self.t[rows, None]
        return np.hstack([np.ones_like(t), t, np.maximum(t - self.knots, 0.0)])

    def _effects(self, rows: slice) -> np.ndarray:
        days = self.days[rows, None]
        parts = [np.zeros((len(days), 0))]
        for period, order in self.fourier:
            angle = 2 * np.pi * np.arange(1, order + 1) * days / period
            parts += [np.sin(angle), np.cos(angle)]
        if self.names:
            flags = np.zeros((len(days), len(self.names)))
            for i, present in enumerate(self.holidays[rows]):
                for name in present if present is not None else ():
                    if name in self.names:
                        flags[i, self.names.index(name)] = 1.0
            parts.append(flags)
        return np.hstack(parts)

    def trend_values(self, trend: np.ndarray) -> np.ndarray:
        return np.concatenate([columns @ trend for _, columns, _ in self.blocks()])

    def effect_values(self, effects: np.ndarray) -> np.ndarray:
        fixed, slopes = np.split(effects, [self.fixed_width])
        value = np.concatenate([columns @ fixed for _, _, columns in self.blocks()])
        return value + self.regressors @ slopes


def _fit_jointly(design: _Design, sums: _Sums, penalties: _Penalties, mode: str):
    """Trend and effect coefficients by reweighted, penalised Gauss-Newton steps."""
    n_trend, n_change = 2 + len(design.knots), len(design.knots)
    theta = np.zeros(n_trend + design.width)
    flat = np.concatenate([penalties.trend, np.zeros(n_change), penalties.effects])
    changes = slice(2, n_trend)
    additive = mode == "additive"
    total = sums.n.sum()

    def objective(theta, squares):
        noise = 0.5 * total * np.log(max(squares / total, _TINY))
        return noise + 0.5 * flat @ theta**2 + np.abs(theta[changes]).sum() / penalties.change_scale

    equations = _normal_equations(design, sums, theta, n_trend, additive)
    gram, rhs, squares = equations
    best = objective(theta, squares)
    if not additive:
        # Start from the trend alone: effects only have a scale once it is known.
        theta[:n_trend] = _solve(
            gram[:n_trend, :n_trend] / _variance(squares, total)
            + np.diag(flat[:n_trend] + _change_weights(theta, changes, penalties, n_trend)),
            rhs[:n_trend] / _variance(squares, total),
        )
        gram, rhs, squares = _normal_equations(design, sums, theta, n_trend, additive)
        best = objective(theta, squares)
    for _ in range(MAX_ROUNDS):
        variance = _variance(squares, total)
        target = theta
        for _ in range(REWEIGHTS if changes.stop > 2 else 1):
            weights = flat + _change_weights(target, changes, penalties, len(theta))
            target = _solve(gram / variance + np.diag(weights), rhs / variance)
        step = target - theta
        for _ in range(12):
            candidate = theta + step
            if additive:  # the matrix does not depend on the coefficients
                equations = gram, rhs, _squares(design, sums, candidate, n_trend)
            else:
                equations = _normal_equations(design, sums, candidate, n_trend, False)
            value = objective(candidate, equations[2])
            if value <= best:
                break
            step = step / 2
        else:
            break  # no shorter step is better either
        done = best - value < 1e-9 * max(1.0, abs(best))
        theta, best = candidate, value
        gram, rhs, squares = equations
        if done:
            break
    else:
        raise FitError("the fit did not converge")
    return theta[:n_trend], theta[n_trend:]


def _normal_equations(design, sums, theta, n_trend, additive):
    """Gauss-Newton matrix, right-hand side and residual square sum at ``theta``.

    With ``q`` the regressor effect, which may differ between the rows of one
    step, a row is predicted as ``g + s + q`` or ``g * (1 + s + q)``. Every sum
    over rows is written with the sums of its step.
    """
    size = len(theta)
    gram, rhs, squares = np.zeros((size, size)), np.zeros(size), 0.0
    trend, fixed, slopes = np.split(theta, [n_trend, n_trend + design.fixed_width])
    a, e, r = (
        slice(0, n_trend),
        slice(n_trend, n_trend + design.fixed_width),
        slice(n_trend + design.fixed_width, size),
    )
    for rows, A, E in design.blocks():
        m = sums.part(rows)
        g, s = A @ trend, E @ fixed
        q1, qy = m.r @ slopes, m.ry @ slopes
        qr = m.rr @ slopes
        q2 = qr @ slopes
        if additive:
            gram[a, a] += A.T @ (A * m.n[:, None])
            gram[a, e] += A.T @ (E * m.n[:, None])
            gram[a, r] += A.T @ m.r
            gram[e, e] += E.T @ (E * m.n[:, None])
            gram[e, r] += E.T @ m.r
            gram[r, r] += m.rr.sum(axis=0)
            rhs[a] += A.T @ m.y
            rhs[e] += E.T @ m.y
            rhs[r] += m.ry.sum(axis=0)
        else:
            h = 1 + s
            first = m.n * h + q1
            second = m.n * h**2 + 2 * h * q1 + q2
            first_r = h[:, None] * m.r + qr
            gram[a, a] += A.T @ (A * second[:, None])
            gram[a, e] += A.T @ (E * (g * first)[:, None])
            gram[a, r] += A.T @ (g[:, None] * first_r)
            gram[e, e] += E.T @ (E * (g**2 * m.n)[:, None])
            gram[e, r] += E.T @ ((g**2)[:, None] * m.r)
            gram[r, r] += np.tensordot(g**2, m.rr, axes=1)
            rhs[a] += A.T @ (h * m.y + qy + g * (second - first))
            rhs[e] += E.T @ (g * (m.y + g * (first - m.n)))
            rhs[r] += (g[:, None] * (m.ry + g[:, None] * (first_r - m.r))).sum(axis=0)
            squares += (m.yy - 2 * g * (h * m.y + qy) + g**2 * second).sum()
    for left, right in ((a, e), (a, r), (e, r)):
        gram[right, left] = gram[left, right].T
    if additive:
        squares = _squares(design, sums, theta, n_trend)
    return gram, rhs, max(squares, 0.0)


def _squares(design, sums, theta, n_trend):
    """Residual square sum of the additive form."""
    trend, fixed, slopes = np.split(theta, [n_trend, n_trend + design.fixed_width])
    squares = 0.0
    for rows, A, E in design.blocks():
        m, f = sums.part(rows), A @ trend + E @ fixed
        q, qy, q2 = m.r @ slopes, m.ry @ slopes, (m.rr @ slopes) @ slopes
        squares += (m.yy - 2 * (f * m.y + qy) + m.n * f**2 + 2 * f * q + q2).sum()
    return max(squares, 0.0)


def _fit_effects(design, sums, penalties, mode, level, floor):
    """Effect coefficients with the trend held at ``floor + level``."""
    size = design.width
    gram, rhs = np.zeros((size, size)), np.zeros(size)
    e, r = slice(0, design.fixed_width), slice(design.fixed_width, size)
    base = floor + level
    rest = sums.yy - 2 * base * sums.y + sums.n * base**2
    for rows, _, E in design.blocks():
        m, b = sums.part(rows), base[rows]
        g = level[rows] if mode == "multiplicative" else np.ones_like(b)
        gram[e, e] += E.T @ (E * (m.n * g**2)[:, None])
        gram[e, r] += E.T @ ((g**2)[:, None] * m.r)
        gram[r, r] += np.tensordot(g**2, m.rr, axes=1)
        rhs[e] += E.T @ (g * (m.y - m.n * b))
        rhs[r] += (g[:, None] * (m.ry - b[:, None] * m.r)).sum(axis=0)
    gram[r, e] = gram[e, r].T
    theta, total = np.zeros(size), sums.n.sum()
    squares = max(rest.sum(), 0.0)
    for _ in range(MAX_ROUNDS):
        variance = _variance(squares, total)
        theta = _solve(gram / variance + np.diag(penalties.effects), rhs / variance)
        squares = max(rest.sum() - 2 * theta @ rhs + theta @ gram @ theta, 0.0)
        if abs(_variance(squares, total) - variance) <= 1e-9 * variance:
            return theta
    raise FitError("the fit did not converge")


_TINY = 1e-12


def _variance(squares: float, total: float) -> float:
    return max(squares / total, _TINY)


def _change_weights(theta, changes, penalties, size):
    """Ridge weights that stand for the Laplace prior at the current changes."""
    weights = np.zeros(size)
    current = np.maximum(np.abs(theta[changes]), 1e-4)
    if not theta[changes].any():
        current = np.full_like(current, penalties.change_scale)
    weights[changes] = 1 / (penalties.change_scale * current)
    return weights


def _solve(matrix: np.ndarray, rhs: np.ndarray) -> np.ndarray:
    try:
        return np.linalg.solve(matrix, rhs)
    except np.linalg.LinAlgError:
        return np.linalg.lstsq(matrix, rhs, rcond=None)[0]


def _precision(scales: list[float | None]) -> np.ndarray:
    return np.array([1 / scale**2 if scale else 0.0 for scale in scales])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


def _names(column: pd.Series | None) -> list[str]:
    if column is None:
        return []
    return sorted({name for names in column if names is not None for name in names})


def _days(ds: pd.Series) -> np.ndarray:
    return (ds.to_numpy("datetime64[us]") - np.datetime64(0, "us")) / np.timedelta64(1, "D")
