"""Per-series forecasting and backtesting as Spark DataFrame jobs."""

from loomcast.config import ForecastConfig
from loomcast.models.base import NativeModel, SeriesModel
from loomcast.models.registry import register_model
from loomcast.plans.backtest import backtest, run_backtest
from loomcast.plans.forecast import forecast, run_forecast, split_failures

__all__ = [
    "ForecastConfig",
    "NativeModel",
    "SeriesModel",
    "backtest",
    "forecast",
    "register_model",
    "run_backtest",
    "run_forecast",
    "split_failures",
]
