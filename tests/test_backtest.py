"""Backtests against the same windows written as loops."""

import datetime as dt
import random
from dataclasses import replace

import numpy as np
import pandas as pd
import pytest
from helpers import EPOCH, Failing, config, daily, line, looped_backtest, naive, sales

from loomcast import backtest, register_model

# A line fitted per series in the grouped map, without priors.
PLAIN = {
    "kind": "Decomposable", "n_changepoints": 0, "trend_prior_scale": None,
    "yearly_seasonality": False, "weekly_seasonality": False, "daily_seasonality": False,
}


def ragged(freq, seed, n=45):
    """Series with gaps, repeated steps, missing targets and early ends."""
    pick = random.Random(seed)
    rows = []
    for item in range(5):
        for i in range(n - 3 * item):
            at = {
                "D": dt.date(2024, 1, 1) + dt.timedelta(days=i),
                "W": dt.date(2022, 1, 5) + dt.timedelta(days=7 * i + (pick.random() < 0.1)),
                "M": (pd.Timestamp("2019-01-31") + pd.offsets.MonthEnd(i)).date(),
                "H": dt.datetime(2024, 1, 1) + dt.timedelta(hours=i),
            }[freq]
            for _ in range(pick.choice([0, 1, 1, 1, 1, 2, 3])):
                value = None if pick.random() < 0.08 else round(pick.uniform(0, 9), 2) * (pick.random() < 0.9)
                rows.append((1, item, at, value))
    # Too little to fit, and a series with one date before its windows.
    rows += [(2, 0, rows[0][2], 1.0)]
    return rows


def evaluations(df):
    return {
        (r.unique_id, r.model_name, pd.Timestamp(r.cutoff)): r.metric_value for r in df.collect()
    }


def expected(rows, cfg, models):
    frame = pd.DataFrame(rows, columns=["store", "item", "ds", "y"])
    frame["ds"] = pd.to_datetime(frame["ds"])
    frame["y"] = frame["y"].astype(float)
    out = {}
    for (store, item), series in frame.groupby(["store", "item"]):
        for label, predict in models.items():
            for cutoff, value in looped_backtest(series, cfg, predict).items():
                out[f"{store}_{item}", label, cutoff] = value
    return out


UNITS = {
    "D": (7, lambda d: d.toordinal()),
    "W": (52, lambda d: (d - pd.Timestamp("1970-01-01")).days // 7),
    "M": (12, lambda d: d.year * 12 + d.month),
    "H": (24, lambda d: (d - pd.Timestamp("1970-01-01")) // pd.Timedelta(hours=1)),
}


@pytest.mark.parametrize("few", [False, True])
@pytest.mark.parametrize("freq,stride,length", [
    ("D", 7, 7), ("D", 2, 5), ("W", 3, 4), ("M", 2, 3), ("H", 5, 6),
])
def test_matches_loops(spark, freq, stride, length, few):
    rows = ragged(freq, seed=f"{freq}{stride}")
    cfg = config(
        freq=freq, stride=stride, prediction_length=length, backtest_length=24,
        few_rows_per_step=few, active_models=("LinearTrend", "SeasonalNaive", "plain"),
        models={"LinearTrend": {}, "SeasonalNaive": {}, "plain": PLAIN},
    )
    got = evaluations(backtest(sales(spark, rows), cfg))
    want = expected(
        rows, cfg,
        {"LinearTrend": line, "plain": line, "SeasonalNaive": naive(*UNITS[freq])},
    )
    assert got.keys() == want.keys() and len(want) > 10
    for key, value in want.items():
        assert got[key] == pytest.approx(value, abs=1e-7), key


@pytest.mark.parametrize("few", [False, True])
@pytest.mark.parametrize("freq,start", [
    ("D", dt.date(2024, 1, 12)), ("W", "2022-04-06"), ("M", "2020-06-30"),
    ("H", "2024-01-01 15:00:00"), ("D", "2030-01-01"),
])
def test_common_start_matches_loops(spark, freq, start, few):
    """The number of windows follows the end of each series; a late start has none."""
    rows = ragged(freq, seed=f"start {freq}")
    cfg = config(
        freq=freq, stride=4, prediction_length=3, backtest_start=start, few_rows_per_step=few,
        active_models=("LinearTrend", "SeasonalNaive", "plain"),
        models={"LinearTrend": {}, "SeasonalNaive": {}, "plain": PLAIN},
    )
    got = evaluations(backtest(sales(spark, rows), cfg))
    want = expected(
        rows, cfg,
        {"LinearTrend": line, "plain": line, "SeasonalNaive": naive(*UNITS[freq])},
    )
    assert got == pytest.approx(want, abs=1e-7)
    assert bool(want) == (start != "2030-01-01")


def test_short_window_gives_no_row(spark):
    rows = daily(1, 1, [1.0, 2.0, 3.0, 4.0]) + daily(1, 1, [5.0] * 3, EPOCH + dt.timedelta(days=8))
    cfg = config(backtest_length=7)
    assert backtest(sales(spark, rows), cfg).isEmpty()


def test_gap_scores_only_the_overlap(spark):
    """Three days missing before the cutoff: the grid covers four test days."""
    rows = daily(1, 1, [float(i) for i in range(20)])
    later = EPOCH + dt.timedelta(days=23)
    rows += daily(1, 1, [23.0, 24.0, 25.0, 26.0, 999.0, 999.0, 999.0], later)
    cfg = config(backtest_length=7)
    row = backtest(sales(spark, rows), cfg).collect()
    assert len(row) == 1 and row[0].cutoff == later
    assert row[0].metric_value == pytest.approx(0, abs=1e-9)


def test_failed_window_scores_infinity(spark):
    register_model("Failing", Failing)
    rows = daily(1, 1, [1.0] * 20) + daily(2, 1, [1.0] + [2.0] * 7)
    cfg = config(
        backtest_length=7, active_models=("LinearTrend", "Failing"),
        models={"LinearTrend": {}, "Failing": {}},
    )
    for few in (False, True):
        got = {
            (r.unique_id, r.model_name): (r.metric_value, r.status)
            for r in backtest(sales(spark, rows), replace(cfg, few_rows_per_step=few)).collect()
        }
        assert got == {
            ("1_1", "LinearTrend"): (0.0, "ok"),
            ("2_1", "LinearTrend"): (np.inf, "error"),
            ("1_1", "Failing"): (np.inf, "error"),
            ("2_1", "Failing"): (np.inf, "error"),
        }


def test_unknown_metric_gives_nan(spark):
    cfg = config(metric="Unheard", backtest_length=7)
    row = backtest(sales(spark, daily(1, 1, [1.0, 2.0] * 10)), cfg).first()
    assert np.isnan(row.metric_value)
    assert (row.metric_name, row.status) == ("unheard", "unsupported_metric")


def test_one_series_and_date_with_a_third_of_the_rows(spark):
    """Rows piled on one date are counted, fitted and scored one by one."""
    pick = random.Random(5)
    rows = daily(1, 1, [pick.uniform(1, 9) for _ in range(40)])
    rows += [(1, 1, rows[33][2], pick.uniform(1, 9)) for _ in range(500)]
    rows += [row for item in range(2, 27) for row in daily(1, item, [pick.uniform(1, 9)] * 40)]
    cfg = config()
    got = evaluations(backtest(sales(spark, rows), cfg))
    want = expected(rows, cfg, {"LinearTrend": line})
    assert got == pytest.approx(want, abs=1e-9)


def test_strict_keys_with_null_parts(spark):
    rows = [(None, 3, d, v) for _, _, d, v in daily(0, 0, [float(i) for i in range(20)])]
    rows += daily(3, None, [1.0] * 20)
    for few in (False, True):
        cfg = config(
            backtest_length=7, strict_keys=True, few_rows_per_step=few,
            active_models=("LinearTrend", "SeasonalNaive", "plain"),
            models={"LinearTrend": {}, "SeasonalNaive": {}, "plain": PLAIN},
        )
        got = backtest(sales(spark, rows), cfg).collect()
        assert len(got) == 6 and {r.status for r in got} == {"ok"}
        assert {(r.unique_id, r.store_nbr, r.item_nbr) for r in got} == {("3", None, 3), ("3", 3, None)}
