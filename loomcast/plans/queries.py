"""One query per operator over the given tables; ``oracle.py`` has their SQL."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomcast.config import ForecastConfig
from loomcast.functions.steps import add_steps, elapsed, step_number
from loomcast.models.base import SeriesModel
from loomcast.models.registry import register_model
from loomcast.models.regression import changepoint_trend
from loomcast.operators.keys import series_rows
from loomcast.operators.moments import (
    design_moments,
    even_knots,
    fourier_moments,
    hinge_moments,
    relative_gradient,
    with_solution,
)
from loomcast.operators.quality import (
    global_last_date,
    kept_rows,
    missing_ratio,
    removed_series,
    series_profile,
)
from loomcast.operators.scoring import score_windows
from loomcast.operators.steps import explode_horizon, fold_steps, future_grid, resample_spine
from loomcast.operators.windows import actual_windows, backtest_cutoffs, training_windows
from loomcast.plans.backtest import backtest, run_backtest
from loomcast.plans.forecast import forecast, run_forecast, split_failures
from loomcast.session import shared_folder
from loomcast.sources.sinks import stamp
from loomcast.sources.tables import preview, read_source, row_count, scan_sql

# A plain least-squares line out of the decomposable model.
PLAIN = {
    "kind": "Decomposable",
    "n_changepoints": 0,
    "yearly_seasonality": False,
    "weekly_seasonality": False,
    "daily_seasonality": False,
    "trend_prior_scale": None,
    "seasonality_prior_scale": None,
    "holidays_prior_scale": None,
    "regressors_prior_scale": None,
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_source(spark, f"{sf_dir}/{name}.parquet")


# Series over the given tables.


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events keyed by type and user bucket, several rows per day."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("store_nbr"),
        (F.col("user_id") % 20).alias("item_nbr"),
        F.col("ts").alias("date"),
        F.col("value").alias("unit_sales"),
        "event_id",
    )


def event_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A: daily sums of events by type and user bucket."""
    return _daily(event_rows(spark, sf_dir))


def event_rows_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A before aggregation, with the target missing on some rows."""
    lost = (F.col("store_nbr") == "error") & (F.col("event_id") % 3 == 0)
    return event_rows(spark, sf_dir).withColumn(
        "unit_sales", F.when(~lost, F.col("unit_sales"))
    )


def shipped_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B: daily shipped quantity by return flag and line status."""
    return _daily(
        table(spark, sf_dir, "lineitem").select(
            F.col("l_returnflag").alias("store_nbr"),
            F.col("l_linestatus").alias("item_nbr"),
            F.col("l_shipdate").alias("date"),
            F.col("l_quantity").alias("unit_sales"),
        )
    )


def order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C: orders keyed by nation of the customer and priority."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    return orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        F.col("c_nationkey").alias("store_nbr"),
        F.col("o_orderpriority").alias("item_nbr"),
        F.col("o_orderdate").alias("date"),
        F.col("o_totalprice").alias("unit_sales"),
    )


def brand_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D: line items keyed by region and brand, over five tables."""
    lineitem, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    part = table(spark, sf_dir, "part")
    return (
        lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey)
        .join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(part, lineitem.l_partkey == part.p_partkey)
        .select(
            F.col("n_regionkey").alias("store_nbr"),
            F.col("p_brand").alias("item_nbr"),
            F.col("l_shipdate").alias("date"),
            F.col("l_extendedprice").alias("unit_sales"),
        )
    )


def _daily(rows: DataFrame) -> DataFrame:
    return rows.groupBy("store_nbr", "item_nbr", F.col("date").cast("date").alias("date")).agg(
        F.sum("unit_sales").alias("unit_sales")
    )


def config(**changes) -> ForecastConfig:
    """The daily workload shape: 7 steps ahead, windows of 7 over the last 30."""
    base = dict(
        prediction_length=7,
        backtest_length=30,
        stride=7,
        include_history=False,
        few_rows_per_step=True,
        active_models=("LinearTrend",),
        models={"LinearTrend": {}, "SeasonalNaive": {}, "WeekdayProfile": {}},
    )
    return ForecastConfig(**{**base, **changes})


def per_series(label: str, **params) -> dict:
    return {"active_models": (label,), "models": {label: {**PLAIN, **params}}}


def _rounded(df: DataFrame, digits: int = 6, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


def _forecast_rows(df: DataFrame, cfg: ForecastConfig, digits: int = 6, **kwargs) -> DataFrame:
    forecasts, _ = split_failures(forecast(df, cfg, **kwargs))
    return _rounded(forecasts, digits, "y_pred")


# Sources.


def table_scan_count(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    events.createOrReplaceTempView("events_to_count")
    scans = {
        "path": events,
        "table": read_source(spark, "events_to_count"),
        "sql": scan_sql(spark, "events_to_count"),
    }
    counts = [row_count(df).withColumn("source", F.lit(name)) for name, df in scans.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


def scan_three_part(spark, sf_dir):
    """The events read by catalog, schema and name; the entry points at the given files."""
    path = f"{sf_dir}/events.parquet"
    name = f"spark_catalog.default.events_{zlib.crc32(path.encode()):08x}"
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path, "parquet")
    events = read_source(spark, name)
    return events.groupBy("event_type").agg(
        F.count("*").alias("n_rows"), F.max("event_id").alias("last_id")
    )


def preview_rows(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    return preview(events, 5, ("event_id",))


# Keys and quality.


def series_key(spark, sf_dir):
    parts = event_series(spark, sf_dir).withColumn(
        "store_nbr", F.when(F.col("item_nbr") != 0, F.col("store_nbr"))
    )
    cfg = config(strict_keys=True)
    return series_profile(series_rows(parts, cfg), cfg.keys).select(*cfg.keys, "n_rows")


def profile_query(spark, sf_dir):
    cfg = config()
    profiles = [
        series_profile(series_rows(df, cfg), cfg.keys).withColumn("series", F.lit(name))
        for name, df in (
            ("events", event_series(spark, sf_dir)),
            ("shipped", shipped_series(spark, sf_dir)),
        )
    ]
    return profiles[0].unionByName(profiles[1])


def quality_missing_ratio(spark, sf_dir):
    cfg = config()
    profile = series_profile(series_rows(event_rows_with_gaps(spark, sf_dir), cfg), cfg.keys)
    ratio = missing_ratio(F.col("n_missing"), F.col("n_rows"))
    return profile.select(
        "group_id",
        "n_rows",
        "n_missing",
        F.round(ratio, 6).alias("missing_ratio"),
        (ratio <= cfg.missing_threshold).alias("kept"),
    )


def quality_kept_rows(spark, sf_dir):
    cfg = config()
    rows = series_rows(event_rows_with_gaps(spark, sf_dir), cfg)
    return kept_rows(rows, cfg.keys, cfg.missing_threshold)


def quality_removed_series(spark, sf_dir):
    cfg = config()
    profile = series_profile(series_rows(event_rows_with_gaps(spark, sf_dir), cfg), cfg.keys)
    return _rounded(removed_series(profile, cfg.keys, cfg.missing_threshold), 6, "missing_ratio")


def quality_filtered_forecast(spark, sf_dir):
    cfg = config(data_quality_check=True, few_rows_per_step=False)
    return _forecast_rows(event_rows_with_gaps(spark, sf_dir), cfg)


def last_date_query(spark, sf_dir):
    return global_last_date(series_rows(event_series(spark, sf_dir), config()))


# Calendar.


def step_offsets(spark, sf_dir):
    days = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("ds"))
    stamp = F.col("ds").cast("timestamp_ntz")
    return days.distinct().select(
        "ds",
        *[
            add_steps(F.col("ds"), n, freq).alias(f"{freq.lower()}_{'back_' * (n < 0)}{abs(n)}")
            for freq, n in (("D", 1), ("D", -29), ("W", 3), ("M", 1), ("M", 7), ("M", -2))
        ],
        add_steps(stamp, 31, "H").alias("h_31"),
    )


def grid_query(spark, sf_dir):
    cfg = config()
    return future_grid(series_rows(event_series(spark, sf_dir), cfg), cfg)


def grid_by_frequency(spark, sf_dir):
    grids = []
    for freq in ("D", "W", "M", "H"):
        cfg = config(freq=freq, prediction_length=5, backtest_length=5)
        grid = future_grid(series_rows(event_rows(spark, sf_dir), cfg), cfg)
        grids.append(
            grid.withColumns({"ds": F.col("ds").cast("timestamp_ntz"), "freq": F.lit(freq)})
        )
    return grids[0].unionByName(grids[1]).unionByName(grids[2]).unionByName(grids[3])


def resample_query(spark, sf_dir):
    cfg = config()
    spine = resample_spine(series_rows(order_rows(spark, sf_dir), cfg), cfg)
    return _rounded(spine.select("group_id", "ds", "y"), 2, "y")


def series_from_join(spark, sf_dir):
    cfg = config()
    steps = fold_steps(series_rows(brand_rows(spark, sf_dir), cfg), cfg.keys)
    return _rounded(steps, 2, "sum_y")


# Moments.


def _entries(moments: DataFrame, keys: list[str], digits: int) -> DataFrame:
    """One row per entry of the matrix, the right-hand side as its last column."""
    columns = F.transform(F.arrays_zip("gram", "rhs"), lambda r: F.array_append(r["gram"], r["rhs"]))
    lines = moments.select(*keys, F.posexplode(columns).alias("i", "line"))
    entries = lines.select(*keys, "i", F.posexplode("line").alias("j", "value"))
    return _rounded(entries, digits, "value")


def _early_rows(spark, sf_dir, cfg: ForecastConfig) -> tuple[DataFrame, dict]:
    """Shipped series with the columns 1, days since 1970, and the first days of a month."""
    rows = series_rows(shipped_series(spark, sf_dir), cfg)
    early = (F.dayofmonth("ds") <= 5).cast("double")
    return rows, {"one": F.lit(1.0), "t": F.unix_date("ds"), "early": early}


def design_moments_query(spark, sf_dir):
    cfg = config()
    rows, columns = _early_rows(spark, sf_dir, cfg)
    return _entries(design_moments(rows, cfg.keys, columns), cfg.keys, 4)


def solve_moments(spark, sf_dir):
    """Coefficients of every series and whether they solve its equations."""
    cfg = config()
    rows, columns = _early_rows(spark, sf_dir, cfg)
    solved = with_solution(design_moments(rows, cfg.keys, columns, "t"))
    coefficients = {name: F.get("solution", i) for i, name in enumerate(("level", "slope", "effect"))}
    return _rounded(
        solved.withColumns(coefficients).select(
            *cfg.keys, *coefficients, (relative_gradient() < 1e-9).alias("settled")
        ),
        6,
        *coefficients,
    )


def hinge_moments_query(spark, sf_dir):
    """Products of five hinges, from sums between their knots."""
    cfg = config()
    rows = series_rows(shipped_series(spark, sf_dir), cfg)
    series = Window.partitionBy(*cfg.keys)
    days = rows.withColumns(
        {"first": F.min(F.unix_date("ds")).over(series), "last": F.max(F.unix_date("ds")).over(series)}
    )
    knots = even_knots(F.lit(0.0), (F.col("last") - F.col("first")).cast("double"), 5)
    t = F.unix_date("ds") - F.col("first")
    return _entries(hinge_moments(days, cfg.keys, t, knots), cfg.keys, 4)


def fourier_moments_query(spark, sf_dir):
    """Four harmonics of the day over hourly series with many rows an hour."""
    cfg = config(freq="H", few_rows_per_step=False)
    rows = series_rows(event_rows(spark, sf_dir), cfg)
    hours = step_number(F.col("ds"), "H") - step_number(F.lit("2024-01-01").cast("date"), "D") * 24
    moments = fourier_moments(rows, cfg.keys, hours / 24, 1.0, 4)
    return _entries(moments, cfg.keys, 6)


# Forecasts.


def forecast_linear(spark, sf_dir):
    return _forecast_rows(event_series(spark, sf_dir), config())


def forecast_linear_with_history(spark, sf_dir):
    return _forecast_rows(event_series(spark, sf_dir), config(include_history=True))


def forecast_linear_interval(spark, sf_dir):
    """The line with the range that holds four fifths of new targets."""
    cfg = config(models={"LinearTrend": {"interval_width": 0.8}})
    return _rounded(_forecast_rows(event_series(spark, sf_dir), cfg), 5, "y_lower", "y_upper")


def forecast_linear_monthly(spark, sf_dir):
    return _forecast_rows(order_rows(spark, sf_dir), config(freq="M", few_rows_per_step=False), 2)


def forecast_resampled(spark, sf_dir):
    cfg = config(resample=True, include_history=True)
    return _forecast_rows(order_rows(spark, sf_dir), cfg, 2)


def forecast_seasonal_naive(spark, sf_dir):
    return _forecast_rows(event_series(spark, sf_dir), config(active_models=("SeasonalNaive",)))


def forecast_all_models(spark, sf_dir):
    models = ("LinearTrend", "SeasonalNaive", "WeekdayProfile")
    return _forecast_rows(event_series(spark, sf_dir), config(active_models=models))


def forecast_logistic(spark, sf_dir):
    series = shipped_series(spark, sf_dir)
    bounds = series.groupBy("store_nbr", "item_nbr").agg((1.2 * F.max("unit_sales")).alias("cap"))
    capped = series.join(bounds, ["store_nbr", "item_nbr"]).withColumn("floor", F.lit(0.0))
    return _forecast_rows(capped, config(**per_series("logistic", growth="logistic")))


def forecast_logistic_growing_cap(spark, sf_dir):
    """The last cap of a series holds for its horizon."""
    series = shipped_series(spark, sf_dir)
    bounds = series.groupBy("store_nbr", "item_nbr").agg((1.2 * F.max("unit_sales")).alias("base"))
    grown = 0.25 * F.date_diff("date", F.lit("1990-01-01").cast("date"))
    capped = series.join(bounds, ["store_nbr", "item_nbr"]).withColumn("cap", F.col("base") + grown)
    return _forecast_rows(capped, config(**per_series("logistic", growth="logistic")))


def forecast_holiday_effect(spark, sf_dir):
    series = shipped_series(spark, sf_dir)
    years = series.select(F.explode(F.sequence(F.year("date"), F.year("date") + 1)).alias("year"))
    holidays = years.distinct().select(
        "year", F.explode(F.array(F.lit("new_year"), F.lit("mid_year"))).alias("holiday")
    ).select(
        "holiday",
        F.make_date("year", F.when(F.col("holiday") == "new_year", 1).otherwise(7), F.lit(1)).alias(
            "ds"
        ),
    )
    cfg = config(include_history=True, **per_series("holiday", holidays=holidays))
    return _forecast_rows(series, cfg)


def forecast_regressor(spark, sf_dir):
    flag = (F.dayofmonth("date") <= 5).alias("onpromotion")
    series = shipped_series(spark, sf_dir).select("*", flag)
    last = series.groupBy("store_nbr", "item_nbr").agg(F.max("date").alias("last_ds"))
    cfg = config(**per_series("regressor", regressors=("onpromotion",)))
    future = explode_horizon(last, cfg).withColumnRenamed("ds", "date")
    return _forecast_rows(series, cfg, scoring=future.select("store_nbr", "item_nbr", "date", flag))


def forecast_weekly_seasonality(spark, sf_dir):
    cfg = config(include_history=True, **per_series("weekly", weekly_seasonality=True))
    return _forecast_rows(shipped_series(spark, sf_dir), cfg)


def forecast_decomposable(spark, sf_dir):
    full = {"seasonality_mode": "multiplicative", "yearly_seasonality": True}
    cfg = config(
        include_history=True,
        active_models=("Decomposable",),
        models={"Decomposable": {**full, "weekly_seasonality": True, "daily_seasonality": False}},
    )
    return _forecast_rows(shipped_series(spark, sf_dir), cfg)


def forecast_changepoint(spark, sf_dir):
    """A line that may bend once, four fifths into the history."""
    cfg = config()
    rows = series_rows(shipped_series(spark, sf_dir), cfg)
    bent = changepoint_trend(rows, cfg, count=1).where(F.col("error").isNull()).drop("error")
    return _rounded(bent, 6, "y_pred")


def _shares_of_cap(spark, sf_dir) -> DataFrame:
    """Shipped series with zeros on even days of the month, capped at their best day."""
    series = shipped_series(spark, sf_dir)
    bounds = series.groupBy("store_nbr", "item_nbr").agg(F.max("unit_sales").alias("cap"))
    zero = F.dayofmonth("date") % 2 == 0
    return series.join(bounds, ["store_nbr", "item_nbr"]).withColumn(
        "unit_sales", F.when(zero, F.lit(0.0)).otherwise(F.col("unit_sales"))
    )


def forecast_logistic_shares(spark, sf_dir):
    """Logistic growth through targets at the floor, fitted by rounds over all series."""
    cfg = config(active_models=("LogisticTrend",), models={"LogisticTrend": {}})
    return _forecast_rows(_shares_of_cap(spark, sf_dir), cfg)


def forecast_multiplicative(spark, sf_dir):
    """A trend times a week, fitted by rounds over all series."""
    cfg = config(
        active_models=("MultiplicativeSeason",),
        models={"MultiplicativeSeason": {"period": 7, "order": 3}},
    )
    return _forecast_rows(shipped_series(spark, sf_dir), cfg, 3)


def forecast_output_stamped(spark, sf_dir):
    return stamp(forecast_linear(spark, sf_dir), "fixed-run").drop("forecast_timestamp")


def forecast_job_output(spark, sf_dir):
    """What the forecast job writes, read back."""
    folder = shared_folder(spark, "forecast-job")
    cfg = config(train_data=event_series(spark, sf_dir), scoring_output=f"{folder}/forecasts")
    run_forecast(spark, cfg, "fixed-run")
    written = read_source(spark, cfg.scoring_output).drop("forecast_timestamp")
    return _rounded(written, 6, "y_pred")


def forecast_undated_series(spark, sf_dir):
    """All failures of a resampled forecast where one bucket of every type has no dates."""
    undated = event_series(spark, sf_dir).withColumn(
        "date", F.when(F.col("item_nbr") != 3, F.col("date"))
    )
    _, failures = split_failures(forecast(undated, config(resample=True)))
    return failures.select("group_id", "model_name", "error")


def forecast_failures(spark, sf_dir):
    series = event_series(spark, sf_dir)
    first = F.min(F.struct("date", "unit_sales")).alias("first")
    single = series.groupBy().agg(first).select(
        F.lit("single").alias("store_nbr"),
        F.lit(0).cast("bigint").alias("item_nbr"),
        "first.date",
        "first.unit_sales",
    )
    cfg = config(
        active_models=("LinearTrend", "plain"), models={"LinearTrend": {}, "plain": PLAIN}
    )
    _, failures = split_failures(forecast(series.unionByName(single), cfg))
    return failures.select("group_id", "model_name")


class OftenShapeless(SeriesModel):
    """Breaks the contract of a forecast in a way that depends on the series' dates."""

    def fit(self, history: pd.DataFrame) -> OftenShapeless:
        self.way = len(history) % 5
        return self

    def forecast(self, dates: pd.DataFrame) -> pd.DataFrame:
        good = pd.DataFrame({"ds": dates["ds"], "y_pred": 1.0})
        return [
            good,
            good[["ds"]],
            good.assign(y_pred="1"),
            pd.concat([good, good]),
            good["y_pred"],
        ][self.way]


def failures_shapeless(spark, sf_dir):
    """Models that give no proper forecast fail with what is wrong about it."""
    register_model("OftenShapeless", OftenShapeless)
    models = {"OftenShapeless": {}, "LinearTrend": {}}
    cfg = config(active_models=("OftenShapeless",), models=models)
    _, failures = split_failures(forecast(event_series(spark, sf_dir), cfg))
    return failures.select("group_id", "model_name", "error")


# Backtests.


def cutoffs_query(spark, sf_dir):
    cfg = config()
    return backtest_cutoffs(series_rows(event_series(spark, sf_dir), cfg), cfg)


def _steps_and_cutoffs(spark, sf_dir, cfg):
    rows = series_rows(event_series(spark, sf_dir), cfg)
    return rows, fold_steps(rows, cfg.keys), backtest_cutoffs(rows, cfg)


def backtest_train_stats(spark, sf_dir):
    cfg = config()
    _, steps, cutoffs = _steps_and_cutoffs(spark, sf_dir, cfg)
    return _rounded(
        training_windows(steps, cutoffs, cfg).groupBy("group_id", "cutoff").agg(
            F.sum("n_rows").alias("n_train"),
            F.sum("sum_y").alias("sum_y"),
            F.max("ds").alias("last_train"),
        ),
        6,
        "sum_y",
    )


def backtest_actuals(spark, sf_dir):
    cfg = config()
    _, steps, cutoffs = _steps_and_cutoffs(spark, sf_dir, cfg)
    counts = actual_windows(steps, cutoffs, cfg).groupBy("group_id", "cutoff").agg(
        F.sum("n_rows").alias("n_actual"), F.sum("sum_y").alias("sum_y")
    )
    return _rounded(counts.where(F.col("n_actual") >= cfg.prediction_length), 6, "sum_y")


def backtest_smape(spark, sf_dir):
    """The readable form: one copy of the series per window, then plain aggregates."""
    cfg = config()
    rows, steps, cutoffs = _steps_and_cutoffs(spark, sf_dir, cfg)
    full = (
        actual_windows(steps, cutoffs, cfg)
        .groupBy("group_id", "cutoff")
        .agg(F.sum("n_rows").alias("n_actual"))
        .where(F.col("n_actual") >= cfg.prediction_length)
    )
    t = elapsed(F.col("ds"), F.col("cutoff"), cfg.freq)
    y = F.try_divide("sum_y", "n_obs")
    fits = training_windows(steps, cutoffs, cfg).groupBy("group_id", "cutoff").agg(
        F.regr_slope(y, t).alias("slope"),
        F.regr_intercept(y, t).alias("intercept"),
        F.max("ds").alias("last_ds"),
    )
    grid = explode_horizon(fits.join(full, ["group_id", "cutoff"]), cfg)
    predictions = grid.where(F.col("ds") >= F.col("cutoff")).select(
        "group_id",
        F.lit("LinearTrend").alias("model_name"),
        "cutoff",
        F.when(F.col("slope").isNotNull(), F.col("ds")).otherwise(F.col("cutoff")).alias("ds"),
        (F.col("intercept") + F.col("slope") * t).alias("y_pred"),
        F.when(F.col("slope").isNull(), F.lit("too few dates")).alias("error"),
    )
    return _rounded(score_windows(predictions, rows, cfg).drop("error"), 6, "metric_value")


def _evaluations(df: DataFrame, cfg: ForecastConfig) -> DataFrame:
    return _rounded(backtest(df, cfg).drop("error"), 6, "metric_value")


def backtest_smape_cumulative(spark, sf_dir):
    return _evaluations(shipped_series(spark, sf_dir), config())


def backtest_all_models(spark, sf_dir):
    models = ("LinearTrend", "SeasonalNaive", "WeekdayProfile")
    return _evaluations(event_series(spark, sf_dir), config(active_models=models))


def backtest_per_series(spark, sf_dir):
    return _evaluations(event_series(spark, sf_dir), config(**per_series("LinearTrend")))


def backtest_duplicate_dates(spark, sf_dir):
    return _evaluations(event_rows(spark, sf_dir), config(few_rows_per_step=False))


def backtest_other_metrics(spark, sf_dir):
    series = shipped_series(spark, sf_dir)
    parts = [_evaluations(series, config(metric=m)) for m in ("mape", "rmse", "unheard_of")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def backtest_monthly(spark, sf_dir):
    shape = dict(prediction_length=3, backtest_length=12, stride=2)
    cfg = config(freq="M", few_rows_per_step=False, **shape)
    return _evaluations(order_rows(spark, sf_dir), cfg)


def backtest_resampled(spark, sf_dir):
    shape = dict(prediction_length=3, backtest_length=12, stride=2)
    cfg = config(freq="M", resample=True, few_rows_per_step=False, **shape)
    return _evaluations(order_rows(spark, sf_dir), cfg)


def backtest_missing_targets(spark, sf_dir):
    """Null and NaN targets: left out of the fit, scored as 0."""
    target = F.when(F.col("event_id") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("unit_sales"))
    rows = event_rows(spark, sf_dir).withColumn(
        "unit_sales", F.when(F.col("event_id") % 3 != 0, target)
    )
    return _evaluations(rows, config(few_rows_per_step=False))


def backtest_common_start(spark, sf_dir):
    """Windows from one calendar date on; series end years apart."""
    cfg = config(
        backtest_start="1995-05-01", stride=28, few_rows_per_step=False,
        active_models=("LinearTrend", "SeasonalNaive"),
    )
    return _evaluations(shipped_series(spark, sf_dir), cfg)


def backtest_failed_windows(spark, sf_dir):
    """No target before the last 20 days: early windows have nothing to fit."""
    series = event_series(spark, sf_dir)
    last = series.groupBy("store_nbr", "item_nbr").agg(F.max("date").alias("last"))
    late = F.col("date") > F.date_sub("last", 20)
    rows = series.join(last, ["store_nbr", "item_nbr"]).withColumn(
        "unit_sales", F.when(late, F.col("unit_sales"))
    )
    return _rounded(backtest(rows, config()), 6, "metric_value")


def backtest_job_output(spark, sf_dir):
    """What the backtest job writes, read back."""
    folder = shared_folder(spark, "backtest-job")
    cfg = config(train_data=shipped_series(spark, sf_dir), evaluation_output=f"{folder}/scores")
    run_backtest(spark, cfg, "fixed-run")
    written = read_source(spark, cfg.evaluation_output).drop("forecast_timestamp", "error")
    return _rounded(written, 6, "metric_value")


def backtest_decomposable(spark, sf_dir):
    cfg = config(
        active_models=("Decomposable",),
        models={"Decomposable": {"seasonality_mode": "multiplicative"}},
    )
    return _evaluations(shipped_series(spark, sf_dir), cfg)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "table_scan_count": table_scan_count,
    "scan_three_part": scan_three_part,
    "preview_rows": preview_rows,
    "series_key": series_key,
    "series_profile": profile_query,
    "quality_missing_ratio": quality_missing_ratio,
    "quality_kept_rows": quality_kept_rows,
    "quality_removed_series": quality_removed_series,
    "quality_filtered_forecast": quality_filtered_forecast,
    "global_last_date": last_date_query,
    "step_offsets": step_offsets,
    "future_grid": grid_query,
    "future_grid_by_frequency": grid_by_frequency,
    "resample_spine": resample_query,
    "series_from_join": series_from_join,
    "design_moments": design_moments_query,
    "solve_moments": solve_moments,
    "hinge_moments": hinge_moments_query,
    "fourier_moments": fourier_moments_query,
    "forecast_changepoint": forecast_changepoint,
    "forecast_linear": forecast_linear,
    "forecast_linear_with_history": forecast_linear_with_history,
    "forecast_linear_interval": forecast_linear_interval,
    "forecast_linear_monthly": forecast_linear_monthly,
    "forecast_resampled": forecast_resampled,
    "forecast_seasonal_naive": forecast_seasonal_naive,
    "forecast_all_models": forecast_all_models,
    "forecast_logistic": forecast_logistic,
    "forecast_logistic_growing_cap": forecast_logistic_growing_cap,
    "forecast_holiday_effect": forecast_holiday_effect,
    "forecast_regressor": forecast_regressor,
    "forecast_weekly_seasonality": forecast_weekly_seasonality,
    "forecast_decomposable": forecast_decomposable,
    "forecast_logistic_shares": forecast_logistic_shares,
    "forecast_multiplicative": forecast_multiplicative,
    "forecast_output_stamped": forecast_output_stamped,
    "forecast_job_output": forecast_job_output,
    "forecast_undated_series": forecast_undated_series,
    "forecast_failures": forecast_failures,
    "failures_shapeless": failures_shapeless,
    "backtest_cutoffs": cutoffs_query,
    "backtest_train_stats": backtest_train_stats,
    "backtest_actuals": backtest_actuals,
    "backtest_smape": backtest_smape,
    "backtest_smape_cumulative": backtest_smape_cumulative,
    "backtest_all_models": backtest_all_models,
    "backtest_per_series": backtest_per_series,
    "backtest_duplicate_dates": backtest_duplicate_dates,
    "backtest_other_metrics": backtest_other_metrics,
    "backtest_monthly": backtest_monthly,
    "backtest_resampled": backtest_resampled,
    "backtest_missing_targets": backtest_missing_targets,
    "backtest_common_start": backtest_common_start,
    "backtest_failed_windows": backtest_failed_windows,
    "backtest_job_output": backtest_job_output,
    "backtest_decomposable": backtest_decomposable,
}
