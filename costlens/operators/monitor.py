"""Accuracy checks over time, alerts and the retraining decision."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from costlens.functions.calendar import months_by_days, period_start
from costlens.functions.checks import within
from costlens.functions.nulls import nan_to_null
from costlens.operators.evaluate import align_on_date, metrics

CRITICAL_MAPE = 15.0
WARNING_MAPE = 12.0
TARGET_MAPE = 10.0
RETRAINING_MAPE = 15.0


def alert_level(mape: Column, warning: float = WARNING_MAPE, critical: float = CRITICAL_MAPE) -> Column:
    """An accuracy that cannot be computed counts as OK."""
    within("the warning level", warning, 0)
    within("the critical level", critical, 0)
    value = nan_to_null(mape)
    return F.when(value > critical, "CRITICAL").when(value > warning, "WARNING").otherwise("OK")


def check_accuracy(
    measured: DataFrame, warning: float = WARNING_MAPE, critical: float = CRITICAL_MAPE, target: float = TARGET_MAPE
) -> DataFrame:
    """Metrics with alert level and target flag; ``is_evaluable`` tells a real
    OK from a missing one."""
    value = nan_to_null(F.col("mape"))
    return measured.withColumns(
        {
            "alert_level": alert_level(F.col("mape"), warning, critical),
            "meets_target": F.coalesce(value < target, F.lit(False)),
            "is_evaluable": value.isNotNull(),
        }
    )


def check_forecasts(forecasts: DataFrame, actuals: DataFrame, checked_at: Column, keys: Sequence[str] = ("segment", "model")) -> DataFrame:
    """Rows for the performance history from forecasts and actuals."""
    return check_accuracy(metrics(align_on_date(forecasts, actuals), keys)).withColumn(
        "checked_at", checked_at.cast("timestamp")
    )


def append_history(rows: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Append check results to a history table."""
    rows.write.mode("append").format(fmt).save(path)


def recent(history: DataFrame, as_of: str, days: int = 30, time_col: str = "checked_at") -> DataFrame:
    """History of the last ``days`` days before ``as_of``."""
    start = F.lit(as_of).cast("timestamp") - F.make_dt_interval(F.lit(days))
    return history.filter(F.col(time_col) >= start)


def performance_trends(
    history: DataFrame,
    as_of: str,
    days: int = 30,
    window: int = 7,
    keys: Sequence[str] = ("model",),
    time_col: str = "checked_at",
) -> DataFrame:
    """Rolling mean of MAPE and R2 over the last checks of every model."""
    frame = W.partitionBy(*keys).orderBy(time_col).rowsBetween(-(window - 1), 0)
    mean = lambda name: F.when(
        F.count(nan_to_null(F.col(name))).over(frame) == window, F.avg(nan_to_null(F.col(name))).over(frame)
    )
    return recent(history, as_of, days, time_col).withColumns({"mape_trend": mean("mape"), "r2_trend": mean("r2")})


def performance_report(history: DataFrame, period: str | None = None, time_col: str = "checked_at") -> DataFrame:
    """Counts, error range, alert counts and share of checks on target: one row,
    or one per day, week or month. An empty history gives ``no_data``."""
    mape, r2 = nan_to_null(F.col("mape")), nan_to_null(F.col("r2"))
    checks = F.count(F.lit(1))
    level = lambda name: F.count_if(F.col("alert_level") == name)
    columns = [
        F.when(checks > 0, "ok").otherwise("no_data").alias("status"),
        checks.alias("total_checks"),
        F.avg(mape).alias("average_mape"),
        F.avg(r2).alias("average_r2"),
        F.min(mape).alias("min_mape"),
        F.max(mape).alias("max_mape"),
        level("CRITICAL").alias("critical_alerts"),
        level("WARNING").alias("warning_alerts"),
        level("OK").alias("ok_alerts"),
        F.coalesce(F.try_divide(F.count_if("meets_target") * F.lit(100.0), checks.cast("double")), F.lit(0.0)).alias(
            "meets_target_pct"
        ),
    ]
    if period is None:
        return history.agg(*columns)
    start = period_start(F.to_date(time_col), period)
    return history.groupBy(start.alias("period_start")).agg(*columns)


def consecutive_alerts(
    daily_checks: DataFrame,
    warning: float = WARNING_MAPE,
    critical: float = CRITICAL_MAPE,
    days: int = 2,
    keys: Sequence[str] = ("model",),
    date_col: str = "ds",
) -> DataFrame:
    """Runs of days above the warning level. A run of ``days`` or more is a
    WARNING; one day above the critical level makes any run CRITICAL. Of
    several checks on one day the worst counts."""
    order = W.partitionBy(*keys).orderBy(date_col)
    worst = daily_checks.groupBy(*keys, date_col).agg(F.max(nan_to_null(F.col("mape"))).alias("mape"))
    high = worst.filter(F.col("mape") > warning)
    island = F.date_sub(F.col(date_col), F.row_number().over(order))
    runs = (
        high.withColumn("_island", island)
        .groupBy(*keys, "_island")
        .agg(
            F.min(date_col).alias("from_day"),
            F.max(date_col).alias("to_day"),
            F.count(F.lit(1)).alias("run_days"),
            F.max("mape").alias("worst_mape"),
        )
        .drop("_island")
    )
    level = F.when(F.col("worst_mape") > critical, "CRITICAL").when(F.col("run_days") >= days, "WARNING")
    return runs.withColumn("alert_level", level).filter(F.col("alert_level").isNotNull())


def retraining_decision(
    models: DataFrame,
    as_of: str,
    trigger_mape: float = RETRAINING_MAPE,
    max_months: float = 6,
    monthly: bool = True,
    quarterly: bool = True,
    drift: DataFrame | None = None,
) -> DataFrame:
    """Which models to retrain and why.

    ``models`` is ``model, current_mape, last_retraining``. ``drift`` is
    ``model, is_drift`` and adds the trigger ``data_drift``.
    """
    within("the triggering error", trigger_mape, 0)
    within("the months without retraining", max_months, 1)
    months = months_by_days(F.lit(as_of).cast("timestamp"), F.col("last_retraining"))
    mape = nan_to_null(F.col("current_mape"))
    frame = models.withColumn("months_since", months)
    rules = [
        ("performance_degradation", (mape != 0) & (mape > trigger_mape)),
        ("time_based", F.col("months_since") >= float(max_months)),
    ]
    if monthly:
        rules.append(("monthly_schedule", F.col("months_since") >= 1.0))
    if quarterly:
        rules.append(("quarterly_schedule", F.col("months_since") >= 3.0))
    rules.append(("initial_training", F.col("last_retraining").isNull()))
    if drift is not None:
        flags = drift.groupBy("model").agg(F.bool_or("is_drift").alias("_drift"))
        frame = frame.join(flags, "model", "left")
        rules.append(("data_drift", F.coalesce(F.col("_drift"), F.lit(False))))
    named = F.array(*[F.when(condition, F.lit(name)) for name, condition in rules])
    decided = frame.withColumn("triggers", F.filter(named, lambda t: t.isNotNull())).withColumn(
        "should_retrain", F.size("triggers") > 0
    )
    return decided.select("model", "current_mape", "last_retraining", "months_since", "triggers", "should_retrain")


def schedule_rows(models: DataFrame, scheduled: Column, created_at: Column, status: str = "scheduled") -> DataFrame:
    """Retraining-history rows for a set of models."""
    return models.select(
        "model",
        scheduled.cast("timestamp").alias("scheduled_date"),
        F.lit(status).alias("status"),
        created_at.cast("timestamp").alias("created_at"),
    )


def last_retraining(history: DataFrame) -> DataFrame:
    """The newest completed retraining of every model."""
    return (
        history.filter(F.col("status") == "completed")
        .groupBy("model")
        .agg(F.max("scheduled_date").alias("last_retraining"))
    )


def latest_schedule(history: DataFrame) -> DataFrame:
    """The newest history row of every model."""
    return (
        history.groupBy("model")
        .agg(
            F.max_by(F.struct("scheduled_date", "status"), F.struct("created_at", "scheduled_date", "status")).alias("_row"),
            F.max("created_at").alias("created_at"),
        )
        .select("model", "_row.scheduled_date", "_row.status", "created_at")
    )
