"""Job configuration."""

from __future__ import annotations

import logging
from collections.abc import Mapping
from dataclasses import dataclass, field, fields
from datetime import datetime
from typing import Any

_log = logging.getLogger(__name__)

FREQUENCIES = ("D", "W", "M", "H")

# Keys a configuration file may carry that no job reads.
_IGNORED = {"catalog", "db", "experiment_path", "use_case_name", "accelerator"}


@dataclass(frozen=True, kw_only=True)
class ForecastConfig:
    """Everything a forecast or backtest job needs to know.

    Sources and sinks are a table name, a path, or (sources only) a DataFrame.
    ``models`` maps each label in ``active_models`` to its parameters; the
    parameter ``kind`` picks the model and defaults to the label.
    """

    train_data: Any = None
    scoring_data: Any = None
    scoring_output: str | None = None
    evaluation_output: str | None = None
    removed_output: str | None = None
    failures_output: str | None = None
    source_format: str = "parquet"
    sink_format: str = "parquet"

    store_id: str = "store_nbr"
    item_id: str = "item_nbr"
    group_id: str = "group_id"
    date_col: str = "date"
    target: str = "unit_sales"
    cap_col: str = "cap"
    floor_col: str = "floor"
    extra_regressors: tuple[str, ...] = ()

    freq: str = "D"
    prediction_length: int
    backtest_length: int | None = None
    # First cutoff of all series, a date or its text; without it every series starts
    # ``backtest_length`` steps before its own end.
    backtest_start: Any = None
    stride: int = 1
    metric: str = "smape"

    active_models: tuple[str, ...] = ("Decomposable",)
    models: Mapping[str, Mapping[str, Any]] = field(default_factory=lambda: {"Decomposable": {}})

    data_quality_check: bool = False
    missing_threshold: float = 0.2
    resample: bool = False
    include_history: bool = True
    strict_keys: bool = False
    series_partitions: int | None = None
    # The source holds about one row per series and step. One shuffle by series is
    # then enough. Results do not depend on it; leave it off when a series may
    # hold very many rows of one step.
    few_rows_per_step: bool = False

    def __post_init__(self):
        put = lambda name, value: object.__setattr__(self, name, value)
        put("freq", str(self.freq).upper())
        put("metric", str(self.metric).lower())
        put("extra_regressors", tuple(self.extra_regressors or ()))
        put("active_models", tuple(self.active_models))
        if self.backtest_length is None:
            put("backtest_length", self.prediction_length)

        if self.freq not in FREQUENCIES:
            raise ValueError(f"freq must be one of {FREQUENCIES}, got {self.freq!r}")
        for name in ("prediction_length", "stride"):
            if getattr(self, name) < 1:
                raise ValueError(f"{name} must be at least 1")
        if self.backtest_start is not None:
            datetime.fromisoformat(str(self.backtest_start))
        if self.backtest_length < self.prediction_length:
            raise ValueError("backtest_length must not be shorter than prediction_length")
        if not self.active_models:
            raise ValueError("active_models is empty")

    @property
    def keys(self) -> list[str]:
        """Columns that identify one series.

        The joined string alone can merge two series (``1_2``,``3`` and
        ``1``,``2_3``); strict keys keep its parts beside it.
        """
        if self.strict_keys:
            return [self.group_id, self.store_id, self.item_id]
        return [self.group_id]

    @property
    def window_count(self) -> int:
        """Backtest windows per series; with ``backtest_start`` they follow its last date."""
        return (self.backtest_length - self.prediction_length) // self.stride + 1

    @classmethod
    def from_mapping(cls, conf: Mapping[str, Any], **overrides) -> ForecastConfig:
        """Build from ``{"forecasting": {...}, "models": {...}}``, already interpolated."""
        section = dict(conf["forecasting"])
        for name in _IGNORED & section.keys():
            _log.info("configuration key %r has no effect", name)
            del section[name]
        known = {f.name for f in fields(cls)}
        unknown = section.keys() - known
        if unknown:
            raise ValueError(f"unknown configuration keys: {sorted(unknown)}")
        return cls(**{**section, "models": conf["models"], **overrides})
