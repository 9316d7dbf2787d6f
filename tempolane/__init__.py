"""Forecasting of many numeric time series with Spark."""

from tempolane.config import ForecastConfig, SeriesSpec

__all__ = ["ForecastConfig", "SeriesSpec"]
