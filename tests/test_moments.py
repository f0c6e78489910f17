"""Moments and their solve against numpy."""

import datetime as dt
import re

import numpy as np
import pytest
from helpers import EPOCH, config, daily, sales
from pyspark.sql import functions as F

from loomcast import backtest, forecast, split_failures
from loomcast.models.regression import SINGULAR_DESIGN, changepoint_trend
from loomcast.operators.keys import series_rows
from loomcast.operators.moments import (
    design_moments,
    even_knots,
    fourier_moments,
    hinge_moments,
    relative_gradient,
    with_solution,
)

PLAIN = {
    "kind": "Decomposable", "n_changepoints": 0, "trend_prior_scale": None,
    "yearly_seasonality": False, "weekly_seasonality": False, "daily_seasonality": False,
    "seasonality_prior_scale": None, "holidays_prior_scale": None, "regressors_prior_scale": None,
}


def frame(spark, series):
    """Rows (key, x..., y) with columns a, b, c."""
    rows = [(key, *map(float, line)) for key, lines in series.items() for line in lines]
    return spark.createDataFrame(rows, "key int, a double, b double, c double, y double")


def columns():
    return {"one": F.lit(1.0), "a": F.col("a"), "b": F.col("b"), "c": F.col("c")}


def test_solutions_match_numpy(spark):
    draw = np.random.default_rng(3)
    series = {k: draw.normal(size=(20 + k, 4)) * [1, 50, 0.01, 1000] for k in range(12)}
    solved = with_solution(design_moments(frame(spark, series), ["key"], columns()))
    rows = solved.select("key", "solution", relative_gradient().alias("gradient")).collect()
    assert len(rows) == 12
    for row in rows:
        lines = series[row.key]
        x = np.column_stack([np.ones(len(lines)), lines[:, :3]])
        want = np.linalg.lstsq(x, lines[:, 3], rcond=None)[0]
        assert np.allclose(row.solution, want, rtol=1e-8) and row.gradient < 1e-9


def test_singular_zero_and_missing_columns(spark):
    draw = np.random.default_rng(4)
    base = draw.normal(size=(15, 4))
    twice, zero, few = base.copy(), base.copy(), base[:2].copy()
    twice[:, 1] = 2 * twice[:, 0] + 3
    zero[:, 2] = 0
    rows = frame(spark, {0: base, 1: twice, 2: zero, 3: few}).union(
        spark.createDataFrame([(0, None, 1.0, 1.0, 5.0), (4, 1.0, 1.0, 1.0, None)],
                              "key int, a double, b double, c double, y double")
    )
    found = {r.key: r for r in with_solution(design_moments(rows, ["key"], columns())).collect()}
    assert found[0].lost == [0, 1, 0, 0] and found[0].n_obs == 16
    assert found[1].solution is None and found[3].solution is None
    assert found[4].n_obs == 0 and found[4].solution == [0.0] * 4
    x = np.column_stack([np.ones(15), zero[:, :2]])
    want = np.linalg.lstsq(x, zero[:, 3], rcond=None)[0]
    assert np.allclose(found[2].solution, [*want, 0.0])


def test_ridge_and_origin(spark):
    draw = np.random.default_rng(5)
    lines = draw.normal(size=(30, 4))
    lines[:, 0] = 19_000 + np.arange(30)
    moments = design_moments(frame(spark, {0: lines}), ["key"], columns(), "a")
    ridge = F.array(*[F.lit(v) for v in (0.0, 0.5, 2.0, 0.0)])
    row = with_solution(moments, ridge).first()
    x = np.column_stack([np.ones(30), lines[:, 0] - 19_000, lines[:, 1:3]])
    want = np.linalg.solve(x.T @ x + np.diag([0, 0.5, 2.0, 0]), x.T @ lines[:, 3])
    assert row.origin == 19_000 and np.allclose(row.solution, want, rtol=1e-7)


def test_fourier_moments_are_the_products(spark):
    draw = np.random.default_rng(6)
    t = draw.uniform(0, 400, 80)
    y = draw.normal(size=80)
    rows = spark.createDataFrame([(1, float(a), float(b)) for a, b in zip(t, y)], "key int, t double, y double")
    rows = rows.union(spark.createDataFrame([(1, 5.0, None)], rows.schema))
    row = fourier_moments(rows, ["key"], F.col("t"), 7.0, 5).first()
    waves = [f(2 * np.pi * m * t / 7) for f in (np.sin, np.cos) for m in range(1, 6)]
    x = np.column_stack([np.ones(80), t - t.min(), *waves])
    assert np.allclose(np.array(row.gram), x.T @ x, atol=1e-8, rtol=1e-9)
    assert np.allclose(row.rhs, x.T @ y, atol=1e-8) and row.n_obs == 80


@pytest.mark.parametrize("count", [0, 1, 4, 25])
def test_hinge_moments_are_the_products(spark, count):
    draw = np.random.default_rng(7)
    t = np.sort(draw.choice(200, 60, replace=False)).astype(float)
    y = draw.normal(size=60)
    rows = spark.createDataFrame([(1, float(a), float(b)) for a, b in zip(t, y)], "key int, t double, y double")
    rows = rows.union(spark.createDataFrame([(1, 7.0, None), (1, None, 3.0)], rows.schema))
    knots = even_knots(F.lit(float(t[0])), F.lit(float(t[-1])), count)
    row = hinge_moments(rows, ["key"], F.col("t"), knots).first()
    assert len(row.knots) == count
    x = np.column_stack([np.ones(60), t, *[np.maximum(t - s, 0) for s in row.knots]])
    assert np.allclose(np.array(row.gram), x.T @ x) and np.allclose(row.rhs, x.T @ y)
    assert row.n_obs == 60


def test_changepoint_trend_bends_and_reports_failures(spark):
    values = [float(2 * i if i < 40 else 80 - 3 * (i - 40)) for i in range(51)]
    rows = daily(1, 1, values) + daily(2, 2, [1.0, 2.0]) + [(3, 3, None, 1.0), (3, 3, EPOCH, 1.0)]
    cfg = config()
    found = changepoint_trend(series_rows(sales(spark, rows), cfg), cfg, 1).collect()
    good = sorted((r.ds, r.y_pred) for r in found if r.group_id == "1_1")
    assert [d for d, _ in good] == [EPOCH + dt.timedelta(days=51 + h) for h in range(7)]
    assert np.allclose([p for _, p in good], [80 - 3 * (11 + h) for h in range(7)])
    failed = {r.group_id: r.error for r in found if r.error}
    assert failed == {"2_2": SINGULAR_DESIGN, "3_3": "missing date"}


def test_plain_forms_run_without_python(spark, capsys):
    rows = [r for item in range(3) for r in daily(1, item, [i + 5.0 * (i % 7 == item) for i in range(70)])]
    table = sales(spark, rows)
    holidays = spark.createDataFrame([("day", EPOCH + dt.timedelta(days=7 * i)) for i in range(12)],
                                     "holiday string, ds date")
    for extra in ({"weekly_seasonality": True}, {"holidays": holidays}, {}):
        cfg = config(active_models=("m",), models={"m": {**PLAIN, **extra}}, include_history=True)
        forecast(table, cfg).explain()
        text = capsys.readouterr().out
        assert "Pandas" not in text and "Python" not in text and "Arrow" not in text
        forecasts, failures = split_failures(forecast(table, cfg))
        assert failures.isEmpty() and forecasts.count() == 3 * 77


def test_seasons_match_a_dense_fit(spark):
    draw = np.random.default_rng(8)
    y = draw.normal(size=100) + np.arange(100) * 0.3
    cfg = config(active_models=("m",), include_history=True,
                 models={"m": {**PLAIN, "weekly_seasonality": 2, "yearly_seasonality": 1}})
    found = forecast(sales(spark, daily(1, 1, y.tolist())), cfg).orderBy("ds").collect()
    days = (EPOCH - dt.date(1970, 1, 1)).days + np.arange(107.0)
    waves = [f(2 * np.pi * m * days / p) for p, k in ((365.25, 1), (7.0, 2)) for f in (np.sin, np.cos)
             for m in range(1, k + 1)]
    x = np.column_stack([np.ones(107), days - days[0], *waves])
    want = x @ np.linalg.lstsq(x[:100], y, rcond=None)[0]
    assert np.allclose([r.y_pred for r in found], want, atol=1e-6)


def test_singular_series_becomes_a_failure(spark):
    """Three dates cannot carry a weekly season; the other series is not touched."""
    rows = daily(1, 1, [1.0, 2.0, 4.0]) + daily(1, 2, [float(i % 7) for i in range(60)])
    cfg = config(active_models=("m",), models={"m": {**PLAIN, "weekly_seasonality": True}})
    forecasts, failures = split_failures(forecast(sales(spark, rows), cfg))
    assert [(r.group_id, r.error) for r in failures.collect()] == [("1_1", SINGULAR_DESIGN)]
    assert {r.group_id for r in forecasts.collect()} == {"1_2"}


def test_a_backtest_fits_once(spark, capsys):
    """Scoring takes its first date from the source: one grouped map in the whole plan."""
    rows = [r for item in range(3) for r in daily(1, item, [float(i % 9) for i in range(60)])]
    cfg = config(active_models=("m",), models={"m": PLAIN})
    backtest(sales(spark, rows), cfg).explain("formatted")
    assert len(re.findall(r"InPandas \(\d+\)", capsys.readouterr().out)) == 1
