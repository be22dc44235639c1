"""Whole runs: training and comparison, registration, forecasting, monitoring."""
from costlens.plans.forecasting import forecast, forecast_stored
from costlens.plans.monitoring import monitor
from costlens.plans.training import TrainingResult, register_best, segment_series, train

__all__ = ["TrainingResult", "forecast", "forecast_stored", "monitor", "register_best", "segment_series", "train"]
