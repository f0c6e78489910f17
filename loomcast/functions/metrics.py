"""Accuracy metrics as aggregate expressions over joined actuals and forecasts.

``w`` counts the source rows behind one joined row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Smallest denominator of a percentage error: double-precision machine epsilon.
_EPSILON = 2.220446049250313e-16


def _mean(term: Column, w: Column) -> Column:
    return F.sum(term * w) / F.sum(w)


def smape(y: Column, p: Column, w: Column) -> Column:
    """Mean of ``2|y-p| / (|y|+|p|)``, from 0 to 2; 0/0 counts as 0."""
    size = F.abs(y) + F.abs(p)
    return _mean(F.when(size == 0, F.lit(0.0)).otherwise(2 * F.abs(y - p) / size), w)


def mape(y: Column, p: Column, w: Column) -> Column:
    return _mean(F.abs(y - p) / F.greatest(F.abs(y), F.lit(_EPSILON)), w)


def rmse(y: Column, p: Column, w: Column) -> Column:
    return F.sqrt(_mean((y - p) * (y - p), w))


METRICS = {"smape": smape, "mape": mape, "rmse": rmse}
