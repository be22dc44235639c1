"""Accuracy history, trends, report and the retraining decision in one go."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlens.functions.nulls import nan_to_null
from costlens.operators import monitor as m


@dataclass
class MonitoringResult:
    checks: DataFrame
    trends: DataFrame
    report: DataFrame
    decision: DataFrame


def monitor(
    forecasts: DataFrame,
    actuals: DataFrame,
    history: DataFrame,
    retrainings: DataFrame,
    as_of: str,
    days: int = 30,
    drift: DataFrame | None = None,
    keys: Sequence[str] = ("model",),
) -> MonitoringResult:
    """Check forecasts against actuals, join the checks to the history so far
    and decide which models to retrain. Nothing is written."""
    checks = m.check_forecasts(forecasts, actuals, F.lit(as_of), keys)
    known = history.unionByName(checks, allowMissingColumns=True)
    states = (
        checks.groupBy("model")
        .agg(F.max(nan_to_null(F.col("mape"))).alias("current_mape"))
        .join(m.last_retraining(retrainings), "model", "left")
    )
    return MonitoringResult(
        checks,
        m.performance_trends(known, as_of, days, keys=keys),
        m.performance_report(known),
        m.retraining_decision(states, as_of, drift=drift),
    )
