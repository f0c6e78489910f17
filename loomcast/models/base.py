"""The two kinds of model."""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Mapping
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame

from loomcast.config import ForecastConfig


def holiday_column(label: str) -> str:
    return f"holidays {label}"


class NativeModel(ABC):
    """A model written as DataFrame operations over all series at once.

    Both methods return the key columns, ``ds``, ``y_pred`` and ``error``;
    ``backtest`` adds ``cutoff``. A series or window that cannot be fitted gives
    one row with ``error`` set instead of predictions.
    """

    def inputs(self) -> dict[str, Any]:
        """Columns to bring besides the target, named as for a ``SeriesModel``."""
        return {}

    @abstractmethod
    def forecast(self, rows: DataFrame, cfg: ForecastConfig) -> DataFrame: ...

    def forecast_over_steps(self, rows: DataFrame, cfg: ForecastConfig) -> DataFrame:
        """The same rows out of ``series_steps``, which several models can share.

        A model without history may have a lighter plan of its own in ``forecast``;
        beside other models the shared steps are cheaper.
        """
        return self.forecast(rows, cfg)

    @abstractmethod
    def backtest(self, rows: DataFrame, cfg: ForecastConfig) -> DataFrame: ...


class SeriesModel(ABC):
    """A model fitted to one series at a time inside a grouped map.

    A fresh instance is made for every fit. Frames have one row per step in date
    order. History has ``ds``, ``y`` (mean target of the step, NaN when missing),
    ``n_rows``, ``n_obs`` and the sums behind them; the dates to forecast have
    ``ds``, and both have what ``inputs`` asks for.
    """

    def __init__(self, params: Mapping[str, Any]):
        self.params = dict(params)

    def inputs(self) -> dict[str, Any]:
        """What to bring besides the target: ``logistic``, ``regressors``, ``holidays``."""
        return {}

    def worker_copy(self, label: str) -> SeriesModel:
        """The instance sent to workers; it must hold plain data only.

        Its holiday names, if it asked for any, are in ``holiday_column(label)``.
        """
        return self

    def prepare_data(self, history: pd.DataFrame) -> pd.DataFrame:
        return history

    @abstractmethod
    def fit(self, history: pd.DataFrame) -> SeriesModel: ...

    @abstractmethod
    def forecast(self, dates: pd.DataFrame) -> pd.DataFrame:
        """Return ``ds`` and ``y_pred``."""
