import datetime as dt
from dataclasses import replace

import numpy as np
import pandas as pd
import pytest
from helpers import EPOCH, Failing, MeanOf, Shapeless, config, daily, sales
from pyspark.sql import functions as F

from loomcast import forecast, register_model, split_failures
from loomcast.models.decomposable import Decomposable
from loomcast.models.registry import UnknownModelError, resolve_models


def signal(n, slope=0.02, change=None, weekly=0.0, yearly=0.0, mode="additive", noise=0.0, base=20.0):
    t = np.arange(n, dtype=float)
    trend = base + slope * t
    if change:
        trend = trend + 0.08 * np.maximum(t - change, 0)
    season = weekly * np.sin(2 * np.pi * t / 7) + yearly * np.cos(2 * np.pi * t / 365.25)
    y = trend * (1 + season) if mode == "multiplicative" else trend + season
    return y + noise * np.random.default_rng(1).standard_normal(n)


def frame(y, start="2020-01-01", freq="D"):
    y = np.asarray(y, float)
    return pd.DataFrame({
        "ds": pd.date_range(start, periods=len(y), freq=freq).to_numpy("datetime64[us]"),
        "n_rows": 1, "n_obs": 1, "sum_y": y, "sum_yy": y * y, "max_abs": np.abs(y), "y": y,
    })


def fitted(y, ahead=30, **params):
    """In-sample and out-of-sample relative errors of a fit to all but the last values."""
    data = frame(y)
    past = data.iloc[:-ahead]
    model = Decomposable(params)
    model.fit(model.prepare_data(past))
    error = np.abs(model.forecast(data)["y_pred"].to_numpy() - y) / np.abs(y).mean()
    return error[:-ahead].mean(), error[-ahead:].mean()


def test_recovers_trend_and_change():
    y = signal(400, change=200)
    inside, ahead = fitted(y, weekly_seasonality=False)
    assert inside < 0.005 and ahead < 0.02


def test_recovers_weekly_season():
    inside, ahead = fitted(signal(200, weekly=4.0, noise=0.2))
    assert inside < 0.02 and ahead < 0.03


def test_recovers_yearly_season():
    inside, ahead = fitted(signal(1200, weekly=2.0, yearly=5.0, noise=0.2))
    assert inside < 0.02 and ahead < 0.03


def test_recovers_multiplicative_season():
    y = signal(1200, slope=0.05, weekly=0.3, yearly=0.2, mode="multiplicative", noise=0.2)
    inside, ahead = fitted(y, seasonality_mode="multiplicative")
    assert inside < 0.02 and ahead < 0.02
    assert fitted(y)[1] > 2 * ahead


def test_recovers_daily_season_of_hours():
    t = np.arange(24 * 20)
    y = 10 + 3 * np.sin(2 * np.pi * t / 24)
    data = frame(y, freq="h")
    model = Decomposable({"weekly_seasonality": False})
    model.fit(data.iloc[:-24])
    assert model.fourier == [(1.0, 4)]
    assert np.abs(model.forecast(data)["y_pred"] - y).max() < 0.1


def test_logistic_growth_stays_below_cap():
    t = np.arange(300)
    y = 2 + 8 / (1 + np.exp(-(t - 150) / 30))
    data = frame(y)
    z = np.log((y - 2) / (10 - y))
    data = data.assign(cap=10.0, floor=2.0, n_z=1, sum_z=z, sum_zz=z * z, max_abs_z=np.abs(z))
    model = Decomposable({"growth": "logistic", "weekly_seasonality": False})
    past = data.iloc[:200]
    model.fit(model.prepare_data(past))
    got = model.forecast(data)["y_pred"].to_numpy()
    assert np.abs(got - y).max() < 0.4 and got.max() < 10


def test_automatic_seasonality_follows_history():
    terms = lambda n, freq: Decomposable({}).fit(frame(np.arange(n), freq=freq)).fourier
    assert terms(13, "D") == []
    assert terms(15, "D") == [(7.0, 3)]
    assert terms(731, "D") == [(365.25, 10), (7.0, 3)]
    assert terms(110, "7D") == [(365.25, 10)]


def test_blocks_do_not_change_the_fit(monkeypatch):
    import loomcast.models.decomposable as module

    y = signal(300, weekly=0.2, mode="multiplicative", noise=0.3)
    whole = Decomposable({"seasonality_mode": "multiplicative"}).fit(frame(y)).forecast(frame(y))
    monkeypatch.setattr(module, "BLOCK_ROWS", 64)
    parts = Decomposable({"seasonality_mode": "multiplicative"}).fit(frame(y)).forecast(frame(y))
    assert np.allclose(whole["y_pred"], parts["y_pred"], rtol=1e-6)


@pytest.mark.parametrize("mode", ["additive", "multiplicative"])
def test_folded_rows_fit_like_source_rows(spark, mode):
    """Repeated dates whose regressor differs from row to row."""
    pick = np.random.default_rng(3)
    n = 360
    t = np.sort(pick.integers(0, 90, n))
    r = pick.uniform(0, 2, n)
    shape = 0.2 * np.sin(2 * np.pi * t / 7) + 0.3 * r
    trend = 10 + 0.1 * t
    y = (trend * (1 + shape) if mode == "multiplicative" else trend + shape) + pick.normal(0, 0.1, n)
    rows = [(1, 1, EPOCH + dt.timedelta(days=int(a)), float(b), float(c)) for a, b, c in zip(t, y, r)]
    future = [(1, 1, EPOCH + dt.timedelta(days=90 + i), 0.1 * i) for i in range(10)]
    scoring = spark.createDataFrame(future, "store_nbr int, item_nbr int, date date, promo double")
    params = {"seasonality_mode": mode, "regressors": ["promo"], "n_changepoints": 5}
    cfg = config(
        include_history=False, active_models=("Decomposable",), models={"Decomposable": params}
    )
    got = forecast(sales(spark, rows, "promo double"), cfg, scoring).orderBy("ds").toPandas()
    assert got["error"].isna().all()

    # The same model on unfolded rows: one "step" per source row.
    one = frame(y).assign(ds=np.datetime64("2024-01-01", "us") + t * np.timedelta64(1, "D"))
    one = one.assign(
        r_promo=r, rr_promo_promo=r * r, ry_promo=r * y, rm_promo=r, nr_promo=1
    )
    last = int(t.max())
    ahead = pd.DataFrame({
        "ds": np.datetime64("2024-01-01", "us") + (last + 1 + np.arange(7)) * np.timedelta64(1, "D"),
        "rm_promo": [0.1 * (last + 1 + i - 90) for i in range(7)],
    })
    direct = Decomposable(params).fit(one).forecast(ahead)["y_pred"]
    assert np.allclose(got["y_pred"], direct, rtol=1e-6)


def test_missing_future_regressor_is_a_failure(spark):
    rows = [(*row, 1.0) for row in daily(1, 1, [1.0, 2.0, 4.0, 3.0] * 5)]
    df = sales(spark, rows, "promo double")
    cfg = config(active_models=("Decomposable",), models={"Decomposable": {"regressors": ["promo"]}})
    forecasts, failures = split_failures(forecast(df, cfg, df.drop("unit_sales")))
    assert forecasts.isEmpty() and failures.count() == 1
    with pytest.raises(ValueError, match="scoring"):
        forecast(df, cfg)


def test_unknown_past_regressor_leaves_one_date_out(spark):
    rows = [(*row, 1.0) for row in daily(1, 1, [1.0, 2.0, 4.0, 3.0] * 5)]
    rows[3] = (*rows[3][:3], None, None)
    future = [(1, 1, EPOCH + dt.timedelta(days=20 + i), 0.5) for i in range(7)]
    scoring = spark.createDataFrame(future, "store_nbr int, item_nbr int, date date, promo double")
    cfg = config(active_models=("Decomposable",), models={"Decomposable": {"regressors": ["promo"]}})
    got = forecast(sales(spark, rows, "promo double"), cfg, scoring).orderBy("ds").collect()
    assert len(got) == 27 and [i for i, r in enumerate(got) if r.y_pred is None] == [3]


def test_holidays_move_their_dates_only(spark):
    values = [10.0] * 60
    for i in (10, 25, 40):
        values[i] = 20.0
    days = [EPOCH + dt.timedelta(days=i) for i in (10, 25, 40, 63)]
    holidays = spark.createDataFrame(
        [(d, "promo_day") for d in days] + [(days[0], "promo_day"), (EPOCH - dt.timedelta(9), "old")],
        "ds date, holiday string",
    )
    plain = {"kind": "Decomposable", "weekly_seasonality": False}
    others = holidays.where("holiday = 'old'")
    models = {"with": {**plain, "holidays": holidays}, "other": {**plain, "holidays": others}, "without": plain}
    cfg = config(include_history=False, active_models=tuple(models), models=models)
    got = forecast(sales(spark, daily(1, 1, values)), cfg).orderBy("ds").collect()
    by_model = {m: [r.y_pred for r in got if r.model_name == m] for m in models}
    assert [round(v) for v in by_model["with"]] == [10, 10, 10, 20, 10, 10, 10]
    assert by_model["other"] == by_model["without"] and max(by_model["without"]) < 11


def test_models_list_regressors_in_any_order(spark):
    pick = np.random.default_rng(4)
    rows = [
        (*row, float(a), float(b)) for row, a, b in
        zip(daily(1, 1, pick.uniform(1, 9, 40).tolist()), pick.uniform(0, 1, 40), pick.uniform(0, 1, 40))
    ]
    future = [(1, 1, EPOCH + dt.timedelta(days=40 + i), 0.5, 0.1 * i) for i in range(7)]
    scoring = spark.createDataFrame(future, "store_nbr int, item_nbr int, date date, a double, b double")
    kind = {"kind": "Decomposable"}
    models = {"ab": {**kind, "regressors": ["a", "b"]}, "ba": {**kind, "regressors": ["b", "a"]}, "none": kind}
    cfg = config(include_history=False, active_models=tuple(models), models=models)
    got = forecast(sales(spark, rows, "a double, b double"), cfg, scoring).toPandas()
    assert got["error"].isna().all()
    wide = got.pivot(index="ds", columns="model_name", values="y_pred")
    assert np.allclose(wide["ab"], wide["ba"], rtol=1e-6) and not np.allclose(wide["ab"], wide["none"])


@pytest.mark.parametrize("few", [False, True])
def test_horizon_alone_equals_the_end_of_the_full_grid(spark, few):
    pick = np.random.default_rng(6)
    rows = []
    for item in range(4):
        for row in daily(1, item, pick.uniform(1, 9, 25).tolist()):
            rows += [row] * int(pick.integers(0, 3))
    rows += daily(2, 1, [None] * 9) + daily(2, 2, [1.0, 2.0, None])
    names = ("LinearTrend", "SeasonalNaive", "WeekdayProfile", "Decomposable")
    results = []
    for history in (False, True):
        cfg = config(include_history=history, active_models=names, few_rows_per_step=few)
        df = forecast(sales(spark, rows), cfg)
        results.append({(r.group_id, r.model_name, r.ds): (r.y_pred, r.error) for r in df.collect()})
    alone, full = results
    assert len(alone) == 4 * 5 * 7 + 4 and alone.keys() <= full.keys()
    for key, (value, error) in alone.items():
        assert full[key] == (value if value is None else pytest.approx(value, rel=1e-9), error), key


def test_errors_stay_with_their_series_and_model(spark):
    for model in (Failing, Shapeless, MeanOf):
        register_model(model.__name__, model)
    rows = daily(1, 1, [1.0, 3.0] * 10) + daily(2, 1, [4.0]) + daily(3, 1, [None, None, 1.0])
    names = ("LinearTrend", "Decomposable", "Failing", "Shapeless", "MeanOf")
    cfg = config(active_models=names, models={name: {} for name in names}, include_history=False)
    forecasts, failures = split_failures(forecast(sales(spark, rows), cfg))
    failed = {(r.group_id, r.model_name): r.error for r in failures.collect()}
    assert failed == {
        ("2_1", "LinearTrend"): "fewer than two usable dates",
        ("3_1", "LinearTrend"): "fewer than two usable dates",
        ("2_1", "Decomposable"): "fewer than two usable rows",
        ("3_1", "Decomposable"): "fewer than two usable rows",
        **{(g, "Failing"): "RuntimeError: always" for g in ("1_1", "2_1", "3_1")},
        **{(g, "Shapeless"): "forecast lacks columns ['y_pred']" for g in ("1_1", "2_1", "3_1")},
    }
    counts = {
        (r.group_id, r.model_name): r["count"]
        for r in forecasts.groupBy("group_id", "model_name").count().collect()
    }
    assert counts == {
        ("1_1", "LinearTrend"): 7, ("1_1", "Decomposable"): 7,
        **{(g, "MeanOf"): 7 for g in ("1_1", "2_1", "3_1")},
    }
    assert {r.y_pred for r in forecasts.where("model_name = 'MeanOf' and group_id = '1_1'").collect()} == {2.0}


def test_infinite_target_is_a_failure(spark):
    names = ("LinearTrend", "Decomposable")
    df = sales(spark, daily(1, 1, [1.0, 2.0, float("inf"), 4.0]))
    for history in (False, True):
        cfg = config(include_history=history, active_models=names)
        forecasts, failures = split_failures(forecast(df, cfg))
        assert forecasts.isEmpty()
        assert {r.error for r in failures.collect()} == {"infinite target"}


def test_missing_date_is_a_failure(spark):
    rows = daily(1, 1, [1.0, 2.0, 3.0]) + [(1, 1, None, 4.0), (2, 1, None, 1.0)]
    for history in (False, True):
        names = ("LinearTrend", "SeasonalNaive", "Decomposable")
        cfg = config(include_history=history, active_models=names)
        forecasts, failures = split_failures(forecast(sales(spark, rows), cfg))
        assert forecasts.isEmpty()
        assert {(r.group_id, r.model_name, r.error) for r in failures.collect()} == {
            (g, m, "missing date") for g in ("1_1", "2_1") for m in names
        }
        assert failures.count() == 6


@pytest.mark.parametrize("freq", ["D", "W", "M", "H"])
def test_grid_follows_history(spark, freq):
    stamps = {
        "D": pd.date_range("2024-01-01", periods=20), "W": pd.date_range("2024-01-03", periods=20, freq="7D"),
        "M": pd.date_range("2022-01-31", periods=20, freq="ME"), "H": pd.date_range("2024-01-01", periods=20, freq="h"),
    }[freq]
    rows = [
        (1, 1, s.to_pydatetime() if freq == "H" else s.date(), float(i % 5)) for i, s in enumerate(stamps)
    ]
    step = {"D": pd.DateOffset(days=1), "W": pd.DateOffset(days=7), "M": pd.offsets.MonthEnd(1), "H": pd.DateOffset(hours=1)}[freq]
    ahead = [stamps[-1] + step * (i + 1) for i in range(7)]
    names = ("LinearTrend", "SeasonalNaive", "Decomposable")
    for few in (False, True):
        cfg = config(freq=freq, active_models=names, few_rows_per_step=few, backtest_length=7)
        got = forecast(sales(spark, rows), cfg).orderBy("ds").toPandas()
        for name in names:
            ds = pd.to_datetime(got.loc[got["model_name"] == name, "ds"])
            assert list(ds) == [*stamps, *ahead], (freq, name)


def test_logistic_uses_last_cap_and_default_floor(spark):
    rows = [(*row, 12.0) for row in daily(1, 1, [1.0, 2.0, 4.0, 6.0, 8.0, 9.0])]
    rows.append((1, 1, EPOCH + dt.timedelta(days=6), 9.5, 10.0))
    model = {"growth": "logistic", "weekly_seasonality": False}
    cfg = config(include_history=False, active_models=("Decomposable",), models={"Decomposable": model})
    got = forecast(sales(spark, rows, "cap double"), cfg).toPandas()
    assert got["error"].isna().all() and (got["y_pred"] < 10).all() and (got["y_pred"] > 8).all()
    rows[-1] = (*rows[-1][:4], None)
    failed = forecast(sales(spark, rows, "cap double"), cfg).first()
    assert "cap" in failed.error
    with pytest.raises(ValueError, match="cap"):
        forecast(sales(spark, [row[:4] for row in rows]), cfg)


def test_models_are_checked_before_the_job():
    with pytest.raises(KeyError):
        resolve_models(config(active_models=("Absent",)))
    with pytest.raises(UnknownModelError):
        resolve_models(config(active_models=("A",), models={"A": {"kind": "Nope"}}))
    with pytest.raises(TypeError):
        resolve_models(config(active_models=("Decomposable",), models={"Decomposable": {"speed": 1}}))
    for wrong in ({"growth": "flat"}, {"seasonality_mode": "x"}, {"interval_width": 2}):
        with pytest.raises(ValueError):
            Decomposable(wrong)


def test_row_order_and_partitions_do_not_matter(spark):
    values = signal(120, weekly=2.0, noise=0.5)
    df = sales(spark, daily(1, 1, values.tolist()) + daily(1, 2, (values * 2).tolist()))
    results = []
    for frame_, partitions in ((df, 3), (df.orderBy(F.desc("date")).repartition(5), 16)):
        cfg = config(active_models=("Decomposable",), series_partitions=partitions)
        results.append(forecast(frame_, cfg).orderBy("group_id", "ds").toPandas()["y_pred"])
    assert np.allclose(*results, rtol=1e-9)


def test_interval_of_a_line(spark):
    """Both plans, rows that share a date, too few targets, and a model without bounds."""
    draw = np.random.default_rng(8)
    values = (draw.normal(size=30) + np.arange(30)).tolist()
    rows = daily(1, 1, values) + [(1, 1, EPOCH, 4.0)] + daily(1, 2, [1.0, 2.0])
    params = {"LinearTrend": {"interval_width": 0.8}, "SeasonalNaive": {}}
    cfg = config(models=params, include_history=False)
    t, y = np.append(np.arange(30), 0), np.append(values, 4.0)
    slope, level = np.polyfit(t, y, 1)
    spread = np.sqrt(((y - level - slope * t) ** 2).sum() / 29)
    ahead = np.arange(30, 37)
    sxx = ((t - t.mean()) ** 2).sum()
    half = 1.2815515655446 * spread * np.sqrt(1 + 1 / 31 + (ahead - t.mean()) ** 2 / sxx)
    for models in (("LinearTrend",), ("LinearTrend", "SeasonalNaive")):
        out = forecast(sales(spark, rows), replace(cfg, active_models=models)).collect()
        lines = [r for r in out if r.group_id == "1_1" and r.model_name == "LinearTrend"]
        lines.sort(key=lambda r: r.ds)
        assert np.allclose([r.y_upper - r.y_pred for r in lines], half)
        assert np.allclose([r.y_pred - r.y_lower for r in lines], half)
        others = [r for r in out if r not in lines]
        assert others and all(r.y_lower is None and r.y_upper is None for r in others)
    with pytest.raises(ValueError):
        forecast(sales(spark, rows), config(models={"LinearTrend": {"interval_width": 1.5}}))
