"""Backtest job: rolling-origin windows, forecasts per window, metric per window."""

from __future__ import annotations

import logging
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcast.config import ForecastConfig
from loomcast.models.base import SeriesModel
from loomcast.models.registry import resolve_models
from loomcast.operators.grouped import (
    Inputs,
    backtest_series,
    series_design,
    with_default_floor,
    with_holidays,
    with_series_partitions,
)
from loomcast.operators.scoring import score_windows
from loomcast.plans.prepare import check_quality, plain_rows, prepared_rows
from loomcast.session import ensure_checkpoint_dir
from loomcast.sources.sinks import stamp, write_together
from loomcast.sources.tables import read_source

_log = logging.getLogger(__name__)


def backtest(df: DataFrame, cfg: ForecastConfig) -> DataFrame:
    """Evaluations: ``unique_id``, ``model_name``, ``cutoff``, metric, ``status``, ``error``."""
    models = resolve_models(cfg)
    per_series = {k: m for k, m in models.items() if isinstance(m, SeriesModel)}
    inputs = Inputs(models)
    if per_series:
        # Native models follow, so that all models can read the same shuffle.
        cfg = with_series_partitions(cfg, df.sparkSession)
    rows, cfg = prepared_rows(with_default_floor(df, cfg, inputs), cfg, inputs.columns(cfg))
    plain = plain_rows(rows, cfg)

    parts = [
        model.backtest(rows if model.inputs() else plain, cfg).withColumn(
            "model_name", F.lit(label)
        )
        for label, model in models.items()
        if label not in per_series
    ]
    if per_series:
        design = series_design(rows, cfg, inputs, horizon=False)
        design = with_holidays(design, inputs.holidays, cfg.source_format)
        parts.append(backtest_series(design, cfg, per_series))
    predictions = parts[0]
    for part in parts[1:]:
        predictions = predictions.unionByName(part)
    return score_windows(predictions, plain, cfg)


def run_backtest(spark: SparkSession, cfg: ForecastConfig, run_id: str | None = None) -> str:
    """Run the whole job and return its run id."""
    run_id = run_id or str(uuid.uuid4())
    if not cfg.evaluation_output:
        raise ValueError("evaluation_output is not configured")
    source = read_source(spark, cfg.train_data, cfg.source_format)
    if cfg.data_quality_check:
        check_quality(source, cfg, cfg.evaluation_output)
    ensure_checkpoint_dir(spark)
    evaluations = backtest(source, cfg).checkpoint()
    write_together([(stamp(evaluations, run_id), cfg.evaluation_output)], cfg.sink_format)
    failed = evaluations.where("status = 'error'").count()
    if failed:
        _log.warning("%d windows failed; see %s", failed, cfg.evaluation_output)
    _log.info("backtest run %s written to %s", run_id, cfg.evaluation_output)
    return run_id
