"""Forecasting models: native column expressions and per-series fits."""
