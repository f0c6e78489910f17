import pytest
from pyspark.sql import functions as F
from helpers import config, daily, sales

from loomcast import ForecastConfig, backtest, forecast, run_backtest, run_forecast
from loomcast.sources import sinks


def _data(spark):
    rows = daily(1, 1, [float(i) for i in range(40)]) + daily(1, 2, [None] * 30 + [1.0] * 10)
    return sales(spark, rows + daily(1, 3, [5.0]))


def test_forecast_job_writes_all_outputs(spark, tmp_path):
    cfg = config(
        train_data=_data(spark), data_quality_check=True,
        scoring_output=str(tmp_path / "forecasts"), failures_output=str(tmp_path / "failures"),
        removed_output=str(tmp_path / "removed"),
    )
    assert run_forecast(spark, cfg, "run-1") == "run-1"
    out = spark.read.parquet(cfg.scoring_output)
    assert out.columns == ["group_id", "model_name", "ds", "y_pred", "run_id", "forecast_timestamp"]
    assert out.count() == 47 and out.select("run_id", "forecast_timestamp").distinct().count() == 1
    assert [r.group_id for r in spark.read.parquet(cfg.failures_output).collect()] == ["1_3"]
    assert [r.group_id for r in spark.read.parquet(cfg.removed_output).collect()] == ["1_2"]
    # A second run replaces the first.
    run_forecast(spark, cfg)
    again = spark.read.parquet(cfg.scoring_output)
    assert again.count() == 47 and again.first().run_id != "run-1"


@pytest.mark.parametrize("kind", ["path", "table"])
def test_a_broken_write_leaves_the_old_state(spark, tmp_path, monkeypatch, kind):
    name = f"{tmp_path}/out" if kind == "path" else "default.whole_out"
    load = spark.read.parquet if kind == "path" else spark.read.table
    cfg = config(train_data=_data(spark), scoring_output=name)
    run_forecast(spark, cfg, "first")
    state = lambda: [{r.run_id for r in load(n).collect()} for n in (name, f"{name}_failures")]
    assert state() == [{"first"}, {"first"}]

    whole, calls = sinks.write_frame, []

    def breaks(df, target, fmt="parquet", mode="overwrite"):
        calls.append(target)
        if len(calls) == 2:
            df = df.select(F.raise_error(F.lit("disk lost")).alias("x"))
        whole(df, target, fmt, mode)

    monkeypatch.setattr(sinks, "write_frame", breaks)
    with pytest.raises(Exception, match="disk lost"):
        run_forecast(spark, cfg, "second")
    monkeypatch.undo()
    assert state() == [{"first"}, {"first"}]

    move, moved = sinks.rename, []

    def stops(spark, source, target):
        moved.append(source)
        if len(moved) == 4:
            raise OSError("rename lost")
        move(spark, source, target)

    monkeypatch.setattr(sinks, "rename", stops)
    with pytest.raises(OSError, match="rename lost"):
        run_forecast(spark, cfg, "third")
    monkeypatch.undo()
    assert state() == [{"first"}, {"first"}]

    run_forecast(spark, cfg, "fourth")
    assert state() == [{"fourth"}, {"fourth"}]
    left = (
        [p.name for p in tmp_path.iterdir()]
        if kind == "path" else [t.name for t in spark.catalog.listTables("default")]
    )
    assert not [n for n in left if "staged" in n or "old" in n]


def test_jobs_read_and_write_tables(spark):
    _data(spark).write.mode("overwrite").saveAsTable("sales_history")
    cfg = config(
        train_data="spark_catalog.default.sales_history", scoring_output="default.sales_forecast",
        evaluation_output="sales_evaluation", active_models=("LinearTrend", "Decomposable"),
    )
    run_id = run_backtest(spark, cfg)
    out = spark.read.table("sales_evaluation")
    assert out.columns[:6] == [
        "unique_id", "model_name", "cutoff", "metric_name", "metric_value", "status"
    ]
    assert {r.run_id for r in out.collect()} == {run_id}
    run_forecast(spark, cfg)
    assert spark.read.table("default.sales_forecast").groupBy("model_name").count().count() == 2


def test_no_survivors_stops_the_job(spark, tmp_path):
    cfg = config(
        train_data=sales(spark, daily(1, 1, [None] * 30)), data_quality_check=True,
        scoring_output=str(tmp_path / "x"),
    )
    with pytest.raises(ValueError, match="no series"):
        run_forecast(spark, cfg)


@pytest.mark.parametrize("few", [False, True])
def test_quality_filter_applies_to_every_model(spark, few):
    names = ("LinearTrend", "SeasonalNaive", "Decomposable")
    for extra in ({}, {"include_history": False}, {"resample": True}):
        cfg = config(data_quality_check=True, active_models=names, few_rows_per_step=few, **extra)
        groups = forecast(_data(spark), cfg).select("group_id", "model_name").distinct()
        assert groups.where("group_id = '1_2'").isEmpty() and groups.count() == 6
    ids = backtest(_data(spark), config(data_quality_check=True)).select("unique_id").distinct()
    assert [r[0] for r in ids.collect()] == ["1_1"]


def test_configuration_checks():
    for wrong in (
        {"freq": "min"}, {"freq": "MS"}, {"backtest_length": 3}, {"stride": 0}, {"active_models": ()},
    ):
        with pytest.raises(ValueError):
            config(**wrong)
    assert config(freq="d", metric="SMAPE").freq == "D"
    assert ForecastConfig(prediction_length=50).backtest_length == 50


def test_configuration_from_mapping():
    conf = {
        "forecasting": {
            "catalog": "a", "db": "b", "train_data": "a.b.t", "store_id": "s", "item_id": "i",
            "prediction_length": 7, "backtest_length": 30, "stride": 7, "active_models": ["LinearTrend"],
            "extra_regressors": ["onpromotion"], "accelerator": "cpu",
        },
        "models": {"LinearTrend": {}},
    }
    cfg = ForecastConfig.from_mapping(conf, include_history=False)
    assert cfg.window_count == 4 and cfg.store_id == "s" and not cfg.include_history
    conf["forecasting"]["horizon"] = 1
    with pytest.raises(ValueError, match="horizon"):
        ForecastConfig.from_mapping(conf)


def test_missing_columns_raise(spark):
    with pytest.raises(ValueError, match="item_nbr"):
        forecast(_data(spark).drop("item_nbr"), config())


def test_failures_and_removed_series_are_written_without_targets(spark, tmp_path, caplog):
    cfg = config(
        train_data=_data(spark), data_quality_check=True, scoring_output=str(tmp_path / "out"),
        evaluation_output=str(tmp_path / "scores"),
    )
    with caplog.at_level("WARNING"):
        run_forecast(spark, cfg)
    failures = spark.read.parquet(f"{cfg.scoring_output}_failures")
    assert [(r.group_id, r.error) for r in failures.collect()] == [
        ("1_3", "fewer than two usable dates")
    ]
    removed = spark.read.parquet(f"{cfg.scoring_output}_removed")
    assert [r.group_id for r in removed.collect()] == ["1_2"]
    assert "out_failures" in caplog.text and "out_removed" in caplog.text
    run_backtest(spark, cfg)
    assert spark.read.parquet(f"{cfg.evaluation_output}_removed").count() == 1


def test_failed_windows_keep_their_error(spark):
    rows = daily(1, 1, [None] * 25 + [1.0] * 15)
    scores = backtest(sales(spark, rows), config(active_models=("LinearTrend", "Decomposable")))
    failed = scores.where("status = 'error'").collect()
    assert {r.model_name for r in failed} == {"LinearTrend", "Decomposable"}
    assert all(r.error.startswith("fewer than two usable") for r in failed)
    assert scores.where("status = 'ok' and error is not null").count() == 0


def test_undated_rows_fail_with_and_without_resampling(spark):
    df = sales(spark, daily(1, 1, [1.0, 2.0, 3.0]) + [(1, 1, None, 4.0)])
    for resample in (False, True):
        for model in ("LinearTrend", "Decomposable"):
            rows = forecast(df, config(resample=resample, active_models=(model,))).collect()
            assert [r.error for r in rows] == ["missing date"]


def test_filled_in_steps_are_not_scored(spark):
    """Exactly 100 on every second day is an exact fit, whatever lies between."""
    rows = [r for i, r in enumerate(daily(1, 1, [100.0] * 61)) if i % 2 == 0]
    for model in ("LinearTrend", "Decomposable"):
        cfg = config(resample=True, prediction_length=2, backtest_length=6, stride=2,
                     active_models=(model,))
        assert backtest(sales(spark, rows), cfg).count() == 0  # one source row per window
        cfg = config(resample=True, freq="W", prediction_length=2, backtest_length=6, stride=2,
                     active_models=(model,))
        weekly = [r for i, r in enumerate(daily(1, 1, [100.0] * 400)) if i % 7 == 0 and i % 35]
        scores = backtest(sales(spark, weekly), cfg).collect()
        assert scores and all(r.metric_value == pytest.approx(0, abs=1e-9) for r in scores)


def test_extra_regressors_reach_the_models(spark):
    import datetime as dt

    rows = [(s, i, d, v + 10.0 * (d.day % 2), float(d.day % 2))
            for s, i, d, v in daily(1, 1, [1.0] * 60)]
    last = rows[-1][2]
    future = [(1, 1, last + dt.timedelta(days=n), 0.0, float((last + dt.timedelta(days=n)).day % 2))
              for n in range(1, 8)]
    cfg = config(
        extra_regressors=("onpromotion",), include_history=False, active_models=("Decomposable",),
        models={"Decomposable": {"n_changepoints": 0, "weekly_seasonality": False,
                                 "regressors_prior_scale": None}},
    )
    out = forecast(sales(spark, rows, "onpromotion double"), cfg,
                   sales(spark, future, "onpromotion double")).collect()
    assert len(out) == 7
    assert all(r.y_pred == pytest.approx(1 + 10 * (r.ds.day % 2), abs=0.2) for r in out)


def test_targets_at_a_bound_are_failures_not_clipped(spark):
    rows = [(*r, 10.0) for r in daily(1, 1, [0.0, 8.0] * 20)]
    cfg = config(active_models=("Decomposable",), models={"Decomposable": {"growth": "logistic"}})
    out = forecast(sales(spark, rows, "cap double"), cfg).collect()
    assert [r.error for r in out] == ["targets must lie between floor and cap"]
