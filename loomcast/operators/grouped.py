"""Per-series models: the frame they get, and the grouped map that runs them."""

from __future__ import annotations

import datetime as dt
import decimal
import numbers
from collections.abc import Callable, Mapping
from dataclasses import replace
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcast.config import ForecastConfig
from loomcast.functions.missing import nan_to_null, zero_filled
from loomcast.functions.steps import clock, from_clock, to_step
from loomcast.models.base import SeriesModel, holiday_column
from loomcast.operators.keys import require_columns, with_series_key
from loomcast.operators.steps import SOURCED, mean_target, series_steps, with_horizon
from loomcast.operators.windows import cutoff_at, first_cutoff, with_window_index
from loomcast.sources.tables import read_source



class Inputs:
    """What the active per-series models need between them."""

    def __init__(self, models: Mapping[str, SeriesModel]):
        wanted = [model.inputs() for model in models.values()]
        self.logistic = any(w.get("logistic") for w in wanted)
        self.regressors = list(dict.fromkeys(r for w in wanted for r in w.get("regressors") or ()))
        self.holidays = {
            label: source
            for label, w in zip(models, wanted)
            if (source := w.get("holidays")) is not None
        }

    def columns(self, cfg: ForecastConfig) -> list[str]:
        """Source columns besides key, date and target."""
        bounds = [cfg.cap_col, cfg.floor_col] if self.logistic else []
        return [*bounds, *self.regressors]


def with_default_floor(df: DataFrame, cfg: ForecastConfig, inputs: Inputs) -> DataFrame:
    """Logistic growth needs a cap; a floor is optional and defaults to 0."""
    if inputs.logistic:
        require_columns(df, [cfg.cap_col])
        if cfg.floor_col not in df.columns:
            df = df.withColumn(cfg.floor_col, F.lit(0.0))
    return df


def future_regressors(df: DataFrame, cfg: ForecastConfig, names: list[str]) -> DataFrame:
    """Row frame of a scoring table: keys, dates and regressors, without a target."""
    require_columns(df, [cfg.date_col, *names])
    keyed = with_series_key(df, cfg.store_id, cfg.item_id, cfg.group_id)
    return keyed.select(
        *cfg.keys,
        to_step(F.col(cfg.date_col), cfg.freq).alias("ds"),
        *[nan_to_null(F.col(name)).alias(name) for name in names],
    )


def series_design(
    rows: DataFrame,
    cfg: ForecastConfig,
    inputs: Inputs,
    scoring: DataFrame | None = None,
    horizon: bool = True,
) -> DataFrame:
    """Folded steps with all sums the models need, partitioned by series.

    Future regressors travel through the same fold as the history, so they
    reach their series without a join.
    """
    keys, names = cfg.keys, inputs.regressors
    sums = _sums(cfg, inputs)
    if scoring is not None:
        rows = rows.withColumn("_train", F.lit(True)).unionByName(
            scoring.withColumn("_train", F.lit(False)), allowMissingColumns=True
        )
        sourced = F.col(SOURCED) if SOURCED in rows.columns else F.lit(True)
        n_rows = F.count_if(F.col("_train") & sourced)
        sums.append(F.count_if("_train").alias("n_train"))
        means = [
            F.coalesce(F.avg(F.when(F.col("_train"), F.col(r))), F.avg(r)).alias(f"rm_{r}")
            for r in names
        ]
    else:
        n_rows = None
        means = [F.avg(r).alias(f"rm_{r}") for r in names]
    if cfg.few_rows_per_step and not horizon:
        # A backtest scores the rows of a step one by one.
        sums.append(F.collect_list(zero_filled(F.col("y"))).alias("targets"))
    facts = series_steps(rows, cfg, [*sums, *means], n_rows)
    if not horizon:
        return facts.withColumn("h", F.lit(0))
    carried = {*keys, "ds", "last_ds", "bad_date", "h"}
    grown = with_horizon(facts, cfg, [c for c in facts.columns if c not in carried])
    if scoring is not None:
        values = [c for c in grown.columns if c not in (*keys, "ds")]
        grown = grown.groupBy(*keys, "ds").agg(*[F.max(c).alias(c) for c in values])
        grown = grown.where((F.col("n_train") > 0) | (F.col("h") > 0)).drop("n_train")
    return grown


def _sums(cfg: ForecastConfig, inputs: Inputs) -> list[Column]:
    y = F.col("y")
    sums = [F.sum(y * y).alias("sum_yy"), F.max(F.abs(y)).alias("max_abs")]
    targets = {"y": y}
    if inputs.logistic:
        cap, floor = F.col(cfg.cap_col), F.col(cfg.floor_col)
        # Only a target strictly between its bounds has a logit.
        z = F.when((floor < y) & (y < cap), F.log((y - floor) / (cap - y)))
        targets["z"] = z
        sums += [
            F.count(z).alias("n_z"),
            F.sum(z).alias("sum_z"),
            F.sum(z * z).alias("sum_zz"),
            F.max(F.abs(z)).alias("max_abs_z"),
            F.max(cap).alias("cap"),
            F.max(floor).alias("floor"),
        ]
    for i, a in enumerate(inputs.regressors):
        used = F.when(y.isNotNull(), F.col(a))
        sums += [F.count(used).alias(f"nr_{a}"), F.sum(used).alias(f"r_{a}")]
        sums += [F.sum(F.col(a) * value).alias(f"r{t}_{a}") for t, value in targets.items()]
        sums += [F.sum(used * F.col(b)).alias(f"rr_{a}_{b}") for b in inputs.regressors[i:]]
    return sums


def with_holidays(
    design: DataFrame, sources: Mapping[str, Any], fmt: str = "parquet"
) -> DataFrame:
    """Add each model's holiday names of the date; null on ordinary days."""
    for label, source in sources.items():
        frame = read_source(design.sparkSession, source, fmt)
        calendar = frame.groupBy(F.col("ds").cast("date").alias("_day")).agg(
            F.array_sort(F.collect_set("holiday")).alias(holiday_column(label))
        )
        on_day = F.col("ds").cast("date") == F.col("_day")
        design = design.join(calendar, on_day, "left").drop("_day")
    return design


def with_series_partitions(cfg: ForecastConfig, spark: SparkSession) -> ForecastConfig:
    """Fix the tasks of a grouped map where the configuration does not: four per core at least."""
    if cfg.series_partitions:
        return cfg
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(shuffle, 4 * spark.sparkContext.defaultParallelism)
    return replace(cfg, series_partitions=tasks)


def _worker_frame(design: DataFrame, cfg: ForecastConfig, extra: list[Column]) -> DataFrame:
    """Numbers instead of date objects, and no column the models do not read."""
    dropped = {"ds", "last_ds", "first_cutoff", *cfg.keys}
    return design.select(
        *cfg.keys,
        clock(F.col("ds"), cfg.freq).cast("bigint").alias("x"),
        mean_target().alias("y"),
        *[design[f"`{c}`"] for c in design.columns if c not in dropped],
        *extra,
    )


def _key_schema(df: DataFrame, keys: list[str]) -> str:
    return ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)


def forecast_series(
    design: DataFrame, cfg: ForecastConfig, models: Mapping[str, SeriesModel]
) -> DataFrame:
    """Fit and forecast every model on every series in one grouped map."""
    frame = _worker_frame(design, cfg, [])
    run = make_forecaster(
        {label: model.worker_copy(label) for label, model in models.items()},
        cfg.keys,
        _unit(cfg),
        cfg.include_history,
    )
    schema = (
        f"{_key_schema(frame, cfg.keys)}, model_name string, x bigint, y_pred double, error string"
    )
    out = frame.groupBy(*cfg.keys).applyInPandas(run, schema)
    return out.select(
        *cfg.keys, "model_name", from_clock(F.col("x"), cfg.freq).alias("ds"), "y_pred", "error"
    )


def backtest_series(
    design: DataFrame, cfg: ForecastConfig, models: Mapping[str, SeriesModel]
) -> DataFrame:
    """All windows of a series inside one call, so its rows are shuffled once."""
    design = with_window_index(design.where(F.col("ds").isNotNull()), cfg)
    last = clock(F.col("last_ds"), cfg.freq).cast("bigint").alias("last_x")
    frame = _worker_frame(design, cfg, [last])
    run = make_backtester(
        {label: model.worker_copy(label) for label, model in models.items()},
        cfg.keys,
        _unit(cfg),
        cfg.freq,
        (cfg.prediction_length, cfg.stride),
        "targets" in frame.columns,
    )
    with_targets = "targets" in frame.columns
    schema = (
        f"{_key_schema(frame, cfg.keys)}, model_name string, k int, last_x bigint, "
        f"x bigint, y_pred double, error string{', targets array<double>' * with_targets}"
    )
    out = frame.groupBy(*cfg.keys).applyInPandas(run, schema)
    first = first_cutoff(from_clock(F.col("last_x"), cfg.freq), cfg)
    return out.select(
        *cfg.keys,
        "model_name",
        cutoff_at(first, F.col("k"), cfg).alias("cutoff"),
        from_clock(F.col("x"), cfg.freq).alias("ds"),
        "y_pred",
        "error",
        *([F.explode("targets").alias("y"), F.lit(1).alias("weight")] if with_targets else []),
    )


def _unit(cfg: ForecastConfig) -> str:
    return "h" if cfg.freq == "H" else "D"


# Functions below run in Python workers and hold plain data only.


def make_forecaster(
    models: Mapping[str, SeriesModel], keys: list[str], unit: str, include_history: bool
) -> Callable[[pd.DataFrame], pd.DataFrame]:
    columns = [*keys, "model_name", "x", "y_pred", "error"]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = []
        bad_date = bool(pdf["bad_date"].iloc[0])
        pdf = _in_order(pdf, unit)
        history = pdf[pdf["h"] == 0]
        dates = pdf if include_history else pdf[pdf["h"] > 0]
        for label, model in models.items():
            error = "missing date" if bad_date else None
            result = None
            if error is None:
                result, error = attempt(model, history, dates, dates["h"] > 0, unit)
            if error is not None:
                result = pd.DataFrame({"x": [pd.NA], "y_pred": [np.nan]})
            parts.append(
                result.assign(model_name=label, error=error, **{k: pdf[k].iloc[0] for k in keys})
            )
        return _typed(pd.concat(parts, ignore_index=True))[columns]

    return run


def make_backtester(
    models: Mapping[str, SeriesModel],
    keys: list[str],
    unit: str,
    freq: str,
    shape: tuple[int, int],
    with_targets: bool,
) -> Callable[[pd.DataFrame], pd.DataFrame]:
    length, stride = shape
    kept = ["targets"] if with_targets else []
    columns = [*keys, "model_name", "k", "last_x", "x", "y_pred", "error", *kept]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = _in_order(pdf, unit)
        i = pdf["i"].to_numpy()
        parts = []
        for k in range(pdf["last_k"].iloc[0] + 1):
            start = k * stride
            train = pdf[i < start]
            actual = pdf[(i >= start) & (i < start + length)]
            if not train["n_rows"].sum() or actual["n_rows"].sum() < length:
                continue
            ahead = steps_ahead(actual, train.iloc[-1], freq)
            dates = actual[(ahead >= 1) & (ahead <= length)]
            for label, model in models.items():
                result, error = attempt(model, train, dates, dates["h"] == 0, unit)
                if error is not None:
                    # On a date with source rows, where scoring meets it.
                    met = actual.loc[actual["n_rows"] > 0, "x"].iloc[0]
                    result = pd.DataFrame({"x": [met], "y_pred": [np.nan]})
                if with_targets:
                    result = result.merge(actual[["x", "targets"]], on="x")
                parts.append(result.assign(model_name=label, k=k, error=error))
        if not parts:
            return pd.DataFrame(columns=columns)
        out = pd.concat(parts, ignore_index=True)
        out = out.assign(last_x=pdf["last_x"].iloc[0], **{key: pdf[key].iloc[0] for key in keys})
        return _typed(out)[columns]

    return run


def steps_ahead(rows: pd.DataFrame, last: pd.Series, freq: str) -> np.ndarray:
    """Steps from the last training row to each row; 0 where off the grid."""
    if freq == "M":
        return rows["i"].to_numpy() - last["i"]
    ahead = rows["x"].to_numpy() - last["x"]
    if freq == "W":
        return np.where(ahead % 7 == 0, ahead // 7, 0)
    return ahead


def attempt(
    model: SeriesModel, history: pd.DataFrame, dates: pd.DataFrame, wanted: pd.Series, unit: str
) -> tuple[pd.DataFrame | None, str | None]:
    """Fit a fresh copy and forecast; a failure stays with this series and model.

    A regressor may be unknown on a date of the past, which then has no
    prediction, but not on a ``wanted`` date.
    """
    try:
        fresh = type(model)(model.params)
        fresh.fit(fresh.prepare_data(history))
        if dates.empty:
            return pd.DataFrame({"x": [], "y_pred": []}), None
        result = fresh.forecast(dates)
        broken = broken_contract(result)
        if broken:
            return None, broken
        ds = pd.to_datetime(result["ds"]).to_numpy("datetime64[us]")
        x = (ds - np.datetime64(0, "us")) // np.timedelta64(1, unit)
        y_pred = pd.to_numeric(result["y_pred"], errors="coerce").to_numpy(float)
        lost = np.isin(dates.loc[wanted, "x"], x[np.isnan(y_pred)])
        if model.inputs().get("regressors") and lost.any():
            return None, "missing regressor value on a forecast date"
        return pd.DataFrame({"x": x, "y_pred": y_pred}), None
    except Exception as problem:  # noqa: BLE001 - any model error is data, not a job failure
        kind = type(problem).__name__
        return None, str(problem) if kind == "FitError" else f"{kind}: {problem}"


def broken_contract(result: object) -> str | None:
    """What keeps a model's forecast from being one: said before any value is cast."""
    if not isinstance(result, pd.DataFrame):
        return f"forecast gave {type(result).__name__}, not a frame"
    absent = {"ds", "y_pred"} - set(result.columns)
    if absent:
        return f"forecast lacks columns {sorted(absent)}"
    if not result.columns.is_unique:
        return "forecast repeats columns"
    kinds = {"ds": (dt.date, np.datetime64), "y_pred": (numbers.Number, decimal.Decimal)}
    typed = {
        "ds": pd.api.types.is_datetime64_any_dtype(result["ds"]),
        "y_pred": pd.api.types.is_numeric_dtype(result["y_pred"]),
    }
    for name, kind in kinds.items():
        values = () if typed[name] else result[name].dropna()
        odd = {type(v).__name__ for v in values if not isinstance(v, kind)}
        if odd:
            return f"forecast holds {sorted(odd)} in {name}"
    if result["ds"].isna().any():
        return "forecast lacks dates"
    if result["ds"].duplicated().any():
        return "forecast repeats dates"
    return None


def _in_order(pdf: pd.DataFrame, unit: str) -> pd.DataFrame:
    pdf = pdf.sort_values("x", ignore_index=True)
    ds = pdf["x"].to_numpy(float)
    known = ~np.isnan(ds)
    stamps = np.full(len(pdf), np.datetime64("NaT"), "datetime64[us]")
    stamps[known] = np.datetime64(0, "us") + ds[known].astype("int64") * np.timedelta64(1, unit)
    return pdf.assign(ds=stamps)


def _typed(out: pd.DataFrame) -> pd.DataFrame:
    out["x"] = out["x"].astype("Int64")
    out["error"] = out["error"].astype(object).where(out["error"].notna(), None)
    return out
