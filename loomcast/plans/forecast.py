"""Forecast job: read, key, check, fit and forecast, write."""

from __future__ import annotations

import logging
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcast.config import ForecastConfig
from loomcast.functions.missing import coerce_number
from loomcast.models.base import SeriesModel
from loomcast.models.registry import resolve_models
from loomcast.models.regression import bound_moment_form
from loomcast.operators.grouped import (
    Inputs,
    forecast_series,
    future_regressors,
    series_design,
    with_default_floor,
    with_holidays,
    with_series_partitions,
)
from loomcast.plans.prepare import check_quality, plain_rows, prepared_rows
from loomcast.session import ensure_checkpoint_dir
from loomcast.sources.sinks import beside, stamp, write_together
from loomcast.sources.tables import read_source

_log = logging.getLogger(__name__)

BOUNDS = ("y_lower", "y_upper")


def forecast(
    df: DataFrame, cfg: ForecastConfig, scoring: DataFrame | None = None
) -> DataFrame:
    """Forecasts and failures of all active models, lazily.

    Columns: series keys, ``model_name``, ``ds``, ``y_pred``, ``error``, and ``y_lower``
    and ``y_upper`` if a model gives them. Use ``split_failures`` to tell them apart.
    """
    models = resolve_models(cfg)
    regressions = {
        label: form
        for label, model in models.items()
        if (form := bound_moment_form(model, df.sparkSession, cfg.source_format))
    }
    models |= regressions
    per_series = {k: m for k, m in models.items() if isinstance(m, SeriesModel)}
    inputs = Inputs(models)
    if per_series:
        # Native models follow, so that all models can read the same shuffle.
        cfg = with_series_partitions(cfg, df.sparkSession)
    rows, cfg = prepared_rows(with_default_floor(df, cfg, inputs), cfg, inputs.columns(cfg))

    future = None
    if inputs.regressors:
        if scoring is None:
            raise ValueError("regressors need scoring data with their future values")
        future = future_regressors(scoring, cfg, inputs.regressors)

    plain = plain_rows(rows, cfg)
    parts = []
    for label, model in models.items():
        if label in regressions:
            model.bind(model.calendar, model.names, future)
            parts.append(model.forecast(rows, cfg).withColumn("model_name", F.lit(label)))
        elif label not in per_series:
            plan = model.forecast_over_steps if len(models) > 1 else model.forecast
            own = rows if model.inputs() else plain
            parts.append(plan(own, cfg).withColumn("model_name", F.lit(label)))
    if per_series:
        design = series_design(rows, cfg, inputs, future)
        design = with_holidays(design, inputs.holidays, cfg.source_format)
        parts.append(forecast_series(design, cfg, per_series))
    fitted = parts[0]
    for part in parts[1:]:
        fitted = fitted.unionByName(part, allowMissingColumns=True)
    y_pred = coerce_number(F.col("y_pred")).alias("y_pred")
    bounds = [c for c in BOUNDS if c in fitted.columns]
    return fitted.select(*cfg.keys, "model_name", "ds", y_pred, *bounds, "error")


def split_failures(fitted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Forecast rows, and one row per series and model that could not be fitted."""
    forecasts = fitted.where(F.col("error").isNull()).drop("error")
    failures = fitted.where(F.col("error").isNotNull()).drop("ds", "y_pred", *BOUNDS)
    return forecasts, failures


def run_forecast(spark: SparkSession, cfg: ForecastConfig, run_id: str | None = None) -> str:
    """Run the whole job and return its run id.

    Failures and removed series are always written: to their configured targets,
    or beside the forecasts under the same name with a suffix. Forecasts and failures
    replace those of the last run together, or neither does.
    """
    run_id = run_id or str(uuid.uuid4())
    resolve_models(cfg)
    if not cfg.scoring_output:
        raise ValueError("scoring_output is not configured")
    source = read_source(spark, cfg.train_data, cfg.source_format)
    scoring = read_source(spark, cfg.scoring_data, cfg.source_format) if cfg.scoring_data is not None else None
    if cfg.data_quality_check:
        check_quality(source, cfg, cfg.scoring_output)
    # Two outputs from one expensive frame: fit once.
    ensure_checkpoint_dir(spark)
    forecasts, failures = split_failures(forecast(source, cfg, scoring).checkpoint())
    failed = failures.count()
    target = cfg.failures_output or beside(cfg.scoring_output, "failures")
    outputs = [(stamp(forecasts, run_id), cfg.scoring_output), (stamp(failures, run_id), target)]
    write_together(outputs, cfg.sink_format)
    if failed:
        _log.warning("%d series could not be fitted by a model; see %s", failed, target)
    _log.info("forecast run %s written to %s", run_id, cfg.scoring_output)
    return run_id
