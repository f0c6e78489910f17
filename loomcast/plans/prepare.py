"""From a source table to the rows models read."""

from __future__ import annotations

import logging
from collections.abc import Iterable
from dataclasses import replace

from pyspark.sql import DataFrame

from loomcast.config import ForecastConfig
from loomcast.operators.keys import series_rows
from loomcast.operators.quality import (
    kept_rows,
    removed_series,
    require_survivors,
    series_profile,
)
from loomcast.operators.steps import SOURCED, resample_spine
from loomcast.session import ensure_checkpoint_dir
from loomcast.sources.sinks import beside, write_together

_log = logging.getLogger(__name__)


def prepared_rows(
    df: DataFrame, cfg: ForecastConfig, extra: Iterable[str] = ()
) -> tuple[DataFrame, ForecastConfig]:
    """Row frame and the configuration that still applies to it.

    The quality filter normally runs inside the models' own pass over the steps
    of a series, where it costs no shuffle. Resampling adds rows, so then the
    filter has to come first.
    """
    rows = series_rows(df, cfg, extra)
    if not cfg.resample:
        return rows, cfg
    if cfg.data_quality_check:
        rows = kept_rows(rows, cfg.keys, cfg.missing_threshold)
    # The spine has one row per step and is already partitioned by series, so
    # folding it moves nothing.
    done = dict(resample=False, data_quality_check=False, few_rows_per_step=False)
    return resample_spine(rows, cfg), replace(cfg, **done)


def plain_rows(rows: DataFrame, cfg: ForecastConfig) -> DataFrame:
    """What models without further inputs read."""
    sourced = [SOURCED] if SOURCED in rows.columns else []
    return rows.select(*cfg.keys, "ds", "y", *sourced)


def check_quality(df: DataFrame, cfg: ForecastConfig, output: str) -> None:
    """Write and count the removed series; fail when no series is left.

    Without a configured target they go beside ``output``.
    """
    rows = series_rows(df, cfg)
    ensure_checkpoint_dir(df.sparkSession)
    profile = series_profile(rows, cfg.keys).checkpoint()
    removed = removed_series(profile, cfg.keys, cfg.missing_threshold)
    target = cfg.removed_output or beside(output, "removed")
    write_together([(removed, target)], cfg.sink_format)
    gone = removed.count()
    if gone:
        _log.warning("%d series have too many missing targets; see %s", gone, target)
    require_survivors(profile, cfg.missing_threshold)
