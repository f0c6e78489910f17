"""Fits by rounds: optimality, failures, and the same fits one series at a time."""

import numpy as np
import pandas as pd
import pytest
from helpers import EPOCH, config, daily, looped_backtest, sales
from pyspark.sql import functions as F

from loomcast import backtest, forecast, split_failures
from loomcast.models.curved import NO_BOUNDS, OUT_OF_BOUNDS
from loomcast.models.linear import INFINITE, TOO_FEW
from loomcast.operators import newton
from loomcast.operators.newton import SINGULAR_DESIGN, UNSETTLED, Point, newton_fits

LOGISTIC = {"active_models": ("LogisticTrend",), "models": {"LogisticTrend": {}}}
SEASON = {"active_models": ("MultiplicativeSeason",), "models": {"MultiplicativeSeason": {}}}


def fractional_logit(y, cap, floor=0.0):
    """Level and slope over scaled time, where both sums of the score vanish."""
    z, u = (np.asarray(y) - floor) / (cap - floor), np.linspace(0, 1, len(y))
    x = np.column_stack([np.ones(len(y)), u])
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ beta))
        beta = beta + np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]), x.T @ (z - p))
    return beta


def capped(spark, series):
    """Series of targets by item, each with its cap and a floor of 0."""
    rows = [
        (*row, cap)
        for item, (values, cap) in series.items()
        for row in daily(1, item, [v if v is None else float(v) for v in values])
    ]
    return sales(spark, rows, "cap double")


def predictions(found, group):
    return np.array([r.y_pred for r in sorted(found, key=lambda r: r.ds) if r.group_id == group])


def test_logistic_is_optimal_with_targets_at_both_bounds(spark):
    draw = np.random.default_rng(1)
    series = {
        1: ([0.0, 0, 0, 1, 0, 2, 3, 5, 4, 8, 9, 10, 10, 10], 10.0),
        2: (list(draw.uniform(0, 50, 40)), 60.0),
        3: ([0.0] * 20, 5.0),
    }
    forecasts, failures = split_failures(forecast(capped(spark, series), config(**LOGISTIC)))
    assert failures.isEmpty()
    found = forecasts.collect()
    for item in (1, 2):
        values, cap = series[item]
        a, b = fractional_logit(values, cap)
        u = np.arange(len(values) + 7) / (len(values) - 1)
        want = cap / (1 + np.exp(-a - b * u))
        assert np.allclose(predictions(found, f"1_{item}"), want, rtol=1e-6)
    assert (predictions(found, "1_3") < 1e-4).all() and len(predictions(found, "1_3")) == 27


def test_logistic_failures_and_moving_caps(spark):
    frame = capped(spark, {
        1: ([1.0, 2, 3, 4], 3.5), 2: ([1.0, -1, 2], 5.0), 3: ([1.0, 2, 3], None),
        4: ([1.0], 5.0), 5: ([None, None], 5.0), 6: ([1.0, float("inf"), 2], 5.0),
        7: ([1.0, 2, 4], 5.0),
    })
    moving = (F.col("item_nbr") == 7) & (F.col("unit_sales") == 4)
    frame = frame.withColumn("cap", F.when(moving, 8.0).otherwise(F.col("cap")))
    forecasts, failures = split_failures(forecast(frame, config(**LOGISTIC)))
    assert {r.group_id: r.error for r in failures.collect()} == {
        "1_1": OUT_OF_BOUNDS, "1_2": OUT_OF_BOUNDS, "1_3": NO_BOUNDS, "1_4": TOO_FEW,
        "1_5": TOO_FEW, "1_6": INFINITE,
    }
    a, b = fractional_logit([0.2, 0.4, 0.5], 1.0)
    want = 8 / (1 + np.exp(-a - b * np.arange(10) / 2))
    assert np.allclose(predictions(forecasts.collect(), "1_7"), want, rtol=1e-6)
    assert forecast(frame.where("false"), config(**LOGISTIC)).isEmpty()


def test_season_is_a_stationary_point_and_finds_a_known_form(spark):
    week = np.array([1.2, 0.7, 0.9, 1.0, 1.3, 1.1, 0.8])
    t = np.arange(70)
    exact = (20 + 0.5 * t) * week[t % 7]
    noisy = exact + np.random.default_rng(2).normal(0, 2, 70)
    rows = daily(1, 1, exact.tolist()) + daily(1, 2, noisy.tolist()) + daily(1, 3, [0.0] * 30)
    # Rows of one date count one by one.
    rows += [(1, 4, *row[2:]) for row in daily(1, 4, noisy.tolist()) for _ in range(2)]
    out, failures = split_failures(forecast(sales(spark, rows), config(**SEASON)))
    assert failures.isEmpty()
    found = out.collect()
    assert (predictions(found, "1_3") == 0).all() and len(predictions(found, "1_3")) == 37
    ahead = np.arange(77)
    assert np.allclose(predictions(found, "1_1"), (20 + 0.5 * ahead) * week[ahead % 7], rtol=1e-6)
    fitted = predictions(found, "1_2")
    rest = noisy - fitted[:70]
    factor = np.array([fitted[k] / fitted[k + 7] for k in range(7)])
    # trend(k) / trend(k + 7) has no week in it; the residual is orthogonal to each slope.
    slope = (1 - factor[0]) / 7
    trend = 1 + slope * t / (1 - 7 * slope) if abs(slope) < 1 / 7 else None
    season = fitted[:70] / trend
    for column in (season, season * t, *[trend * (t % 7 == k) for k in range(7)]):
        assert abs(rest @ column) < 1e-6 * (np.abs(rest) @ np.abs(column))
    assert np.allclose(predictions(found, "1_4"), fitted, rtol=1e-7)


@pytest.mark.parametrize("name", ["logistic", "season"])
def test_backtest_equals_a_loop_over_windows(spark, name):
    draw = np.random.default_rng(3)
    values = np.round(draw.uniform(0, 9, 60), 2)
    frame = capped(spark, {1: (values.tolist(), 10.0)})
    shape = LOGISTIC if name == "logistic" else SEASON
    cfg = config(**{**shape, "backtest_length": 14})
    ours = {r.cutoff: r.metric_value for r in backtest(frame, cfg).collect()}

    def predict(train, dates):
        part = sales(spark, [(1, 1, d.date(), float(y)) for d, y in zip(train["ds"], train["y"])])
        rows = forecast(part.withColumn("cap", F.lit(10.0)), config(include_history=False, **shape))
        return [r.y_pred for r in sorted(rows.collect(), key=lambda r: r.ds)]

    plain = pd.DataFrame({"ds": pd.date_range(EPOCH, periods=60), "y": values})
    wanted = looped_backtest(plain, cfg, predict)
    assert {k.date(): v for k, v in wanted.items()}.keys() == ours.keys()
    for cutoff, value in wanted.items():
        assert ours[cutoff.date()] == pytest.approx(value, rel=1e-6)


def test_unsettled_series_are_failures_and_settled_ones_leave(spark):
    steps = spark.createDataFrame(
        [(1, 1, 2.0), (2, 1, 5.0)], "key int, n_obs bigint, sum_y double"
    )
    start = spark.createDataFrame([(1, [0.5]), (2, [0.5])], "key int, solution array<double>")

    def cube(beta):
        """The cube of its coefficient: the first full step goes much too far."""
        b = F.get(beta, 0)
        rest = F.col("sum_y") - b * b * b
        return Point(b * b * b, [3 * b * b], F.lit(1.0), rest * rest, F.col("sum_y"))

    few = newton_fits(steps, ["key"], start, cube, rounds=2).collect()
    assert {r.error for r in few} == {UNSETTLED}
    many = {r.key: r for r in newton_fits(steps, ["key"], start, cube, rounds=100).collect()}
    assert many[1].solution[0] == pytest.approx(2 ** (1 / 3), rel=1e-6)
    assert many[2].error is None and many[2].solution[0] == pytest.approx(5 ** (1 / 3), rel=1e-6)


def test_a_repeated_column_is_a_singular_design(spark):
    steps = spark.createDataFrame(
        [(1, 1, 2.0, 1.0), (1, 1, 3.0, 2.0)], "key int, n_obs bigint, sum_y double, x double"
    )
    start = spark.createDataFrame([(1, [0.0, 0.0])], "key int, solution array<double>")

    def twice(beta):
        x = F.col("x")
        fitted = (F.get(beta, 0) + F.get(beta, 1)) * x
        return Point(fitted, [x, x], F.lit(1.0), (F.col("sum_y") - fitted) ** 2, F.col("sum_y"))

    assert [r.error for r in newton_fits(steps, ["key"], start, twice).collect()] == [
        SINGULAR_DESIGN
    ]


def test_rounds_move_coefficients_and_no_steps(spark, monkeypatch):
    plans = []

    def watched(steps, keys, state, form):
        found = evaluated(steps, keys, state, form)
        plans.append(found._jdf.queryExecution().executedPlan().toString())
        return found

    evaluated = newton._evaluated
    monkeypatch.setattr(newton, "_evaluated", watched)
    tables = {t.name for t in spark.catalog.listTables()}
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        forecast(capped(spark, {1: ([1, 4, 2, 5, 6], 10.0)}), config(**LOGISTIC)).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    # The one exchange is that of the coefficients.
    assert plans and all(plan.count("Exchange hashpartitioning") == 1 for plan in plans)
    assert all("candidate" in plan.split("Exchange hashpartitioning")[1] for plan in plans)
    assert {t.name for t in spark.catalog.listTables()} == tables
