"""Models by name."""

from __future__ import annotations

from loomcast.config import ForecastConfig
from loomcast.models.base import NativeModel, SeriesModel
from loomcast.models.curved import LogisticTrend, MultiplicativeSeason
from loomcast.models.decomposable import Decomposable
from loomcast.models.linear import LinearTrend
from loomcast.models.seasonal import SeasonalNaive, WeekdayProfile


class UnknownModelError(ImportError):
    """No model of that kind is registered."""


_KINDS: dict[str, type] = {
    "Decomposable": Decomposable,
    "LinearTrend": LinearTrend,
    "LogisticTrend": LogisticTrend,
    "MultiplicativeSeason": MultiplicativeSeason,
    "SeasonalNaive": SeasonalNaive,
    "WeekdayProfile": WeekdayProfile,
}


def register_model(kind: str, model: type[NativeModel] | type[SeriesModel]) -> None:
    """Make a model class, built with its parameter mapping, available by name."""
    _KINDS[kind] = model


def resolve_models(cfg: ForecastConfig) -> dict[str, NativeModel | SeriesModel]:
    """Instances of all active models by label; fails before any job starts."""
    resolved = {}
    for label in cfg.active_models:
        if label not in cfg.models:
            raise KeyError(f"no section for model {label!r} in the models configuration")
        params = dict(cfg.models[label] or {})
        kind = params.pop("kind", label)
        if kind not in _KINDS:
            raise UnknownModelError(f"unknown model kind {kind!r}")
        if kind == "Decomposable" and cfg.extra_regressors:
            # The table's regressors serve every model that does not name its own.
            params.setdefault("regressors", cfg.extra_regressors)
        resolved[label] = _KINDS[kind](params)
    return resolved
