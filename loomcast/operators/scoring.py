"""Scoring window forecasts against the source rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcast.config import ForecastConfig
from loomcast.functions.metrics import METRICS
from loomcast.functions.missing import zero_filled
from loomcast.operators.keys import null_safe_join
from loomcast.operators.steps import SOURCED
from loomcast.operators.windows import first_cutoff


def score_windows(predictions: DataFrame, rows: DataFrame, cfg: ForecastConfig) -> DataFrame:
    """One metric value per series, model and window.

    ``predictions`` holds keys, ``model_name``, ``cutoff``, ``ds``, ``y_pred``
    and ``error``. Source rows join on series *and* date, so a series with very
    many rows spreads over its dates, and the metric is summed per task before
    it travels; adaptive execution splits a date that is still too large. A
    window with an error carries it on a date that has rows, so failed windows
    need no second pass over the predictions. Predictions that already hold the
    target as ``y``, for ``weight`` rows each, need no join.
    """
    keys = cfg.keys
    joined = predictions
    if "y" not in predictions.columns:
        # A step that resampling filled in has no source row to score.
        sourced = F.col(SOURCED) if SOURCED in rows.columns else F.lit(True)
        # Only the last dates are predicted: earlier rows stay out of the exchange. The
        # first of them follows from the last date of each series, without a fit.
        ends = rows.groupBy(*keys).agg(F.max("ds").alias("last_ds"))
        first = ends.select(F.min(first_cutoff(F.col("last_ds"), cfg))).scalar()
        tested = (F.col("ds") >= first) & sourced
        actual = rows.where(tested).select(*keys, "ds", "y")
        joined = null_safe_join(actual, predictions, keys, ["ds"]).withColumn("weight", F.lit(1))
    metric = METRICS.get(cfg.metric)
    y, p = zero_filled(F.col("y")), zero_filled(F.col("y_pred"))
    value = metric(y, p, F.col("weight")) if metric else F.lit(float("nan"))
    scored = joined.groupBy(*keys, "model_name", "cutoff").agg(
        value.alias("value"), F.count("error").alias("errors"), F.max("error").alias("error")
    )
    failed = F.col("errors") > 0
    status = F.when(failed, "error").otherwise("ok" if metric else "unsupported_metric")
    return scored.select(
        F.col(keys[0]).alias("unique_id"),
        *keys[1:],
        "model_name",
        "cutoff",
        F.lit(cfg.metric).alias("metric_name"),
        F.when(failed, F.lit(float("inf"))).otherwise(F.col("value")).alias("metric_value"),
        status.alias("status"),
        "error",
    )
