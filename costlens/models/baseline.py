"""Baseline forecasts and future dates, all built from SQL expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from costlens.functions.nulls import nan_to_null
from costlens.operators.prepare import days


def _future_array(last: Column, periods: int, freq: str) -> Column:
    if freq == "D":
        return F.transform(F.sequence(F.lit(1), F.lit(periods)), lambda i: F.date_add(last, i))
    if freq == "W":
        first = F.next_day(last, "SUN")
        return F.transform(F.sequence(F.lit(0), F.lit(periods - 1)), lambda i: F.date_add(first, i * 7))
    if freq == "M":
        month = F.trunc(F.date_add(last, 1), "month")
        return F.transform(
            F.sequence(F.lit(0), F.lit(periods - 1)), lambda i: F.last_day(F.add_months(month, i))
        )
    raise ValueError(f"unknown frequency: {freq}")


def future_dates(
    history: DataFrame, periods: int, freq: str = "D", keys: Sequence[str] = ("segment",)
) -> DataFrame:
    """``keys, ds, step``: the dates after the last day of every segment; ``W``
    are Sundays and ``M`` month ends."""
    if periods < 1:
        raise ValueError("periods must be at least one")
    last = history.groupBy(*keys).agg(F.max("ds").alias("_last"))
    return last.select(*keys, F.posexplode(_future_array(F.col("_last"), periods, freq)).alias("_pos", "ds")).select(
        *keys, "ds", (F.col("_pos") + 1).alias("step")
    )


def future_frame(history: DataFrame, periods: int, freq: str = "D", keys: Sequence[str] = ("segment",)) -> DataFrame:
    """History dates followed by the future dates."""
    return history.select(*keys, "ds").unionByName(future_dates(history, periods, freq, keys).select(*keys, "ds"))


def _spread(fitted: DataFrame, periods: int, keys: Sequence[str], yhat) -> DataFrame:
    """Repeat a one-row-per-segment fit over the next ``periods`` days."""
    step = F.explode(F.sequence(F.lit(1), F.lit(periods))).alias("step")
    rows = fitted.select("*", step)
    return rows.select(*keys, F.date_add("last", F.col("step")).alias("ds"), yhat(F.col("step")).alias("yhat"))


# Each baseline is fitted to one row per segment, which is all that its forecasts need.


def fit_naive(history: DataFrame, keys: Sequence[str] = ("segment",)) -> DataFrame:
    """``keys, level, last``: the last known value and its day."""
    known = history.filter(nan_to_null(F.col("y")).isNotNull())
    return known.groupBy(*keys).agg(F.max_by("y", "ds").alias("level"), F.max("ds").alias("last"))


def fit_moving_average(history: DataFrame, window: int = 7, keys: Sequence[str] = ("segment",)) -> DataFrame:
    """``keys, level, last``: the mean of the last ``window`` known values."""
    known = history.filter(nan_to_null(F.col("y")).isNotNull())
    newest = F.row_number().over(W.partitionBy(*keys).orderBy(F.col("ds").desc()))
    held = known.withColumn("_position", newest).filter(F.col("_position") <= window)
    return held.groupBy(*keys).agg(F.avg("y").alias("level"), F.max("ds").alias("last"))


def project_level(fitted: DataFrame, periods: int, keys: Sequence[str] = ("segment",)) -> DataFrame:
    return _spread(fitted, periods, keys, lambda step: F.col("level"))


def fit_seasonal_naive(history: DataFrame, season: int = 7, keys: Sequence[str] = ("segment",)) -> DataFrame:
    """``keys, last, cycle``: the values of the last ``season`` days in order of date,
    null for a day that is not known."""
    last = history.groupBy(*keys).agg(F.max("ds").alias("last"))
    near = history.join(last, list(keys)).filter(F.col("ds") > F.date_sub("last", season))
    at = season - F.datediff("last", "ds")
    by_day = near.groupBy(*keys, "last").agg(F.map_from_entries(F.collect_list(F.struct(at.alias("at"), F.col("y").alias("y")))).alias("_by_day"))
    cycle = F.transform(F.sequence(F.lit(1), F.lit(season)), lambda i: F.try_element_at("_by_day", i))
    return by_day.select(*keys, "last", cycle.alias("cycle"))


def project_seasonal_naive(fitted: DataFrame, periods: int, keys: Sequence[str] = ("segment",)) -> DataFrame:
    return _spread(fitted, periods, keys, lambda step: F.get("cycle", F.pmod(step - 1, F.size("cycle"))))


def fit_linear_trend(history: DataFrame, keys: Sequence[str] = ("segment",)) -> DataFrame:
    """``keys, slope, intercept, last`` of the least-squares line over days."""
    day = F.unix_date(F.col("ds")).cast("double")
    y = nan_to_null(F.col("y"))
    return history.groupBy(*keys).agg(
        F.regr_slope(y, day).alias("slope"), F.regr_intercept(y, day).alias("intercept"), F.max("ds").alias("last")
    )


def project_linear_trend(fitted: DataFrame, periods: int, keys: Sequence[str] = ("segment",)) -> DataFrame:
    line = lambda step: F.col("intercept") + F.col("slope") * (F.unix_date("last") + step).cast("double")
    return _spread(fitted, periods, keys, line)


def naive(history: DataFrame, periods: int, keys: Sequence[str] = ("segment",)) -> DataFrame:
    """The last known value, repeated."""
    return project_level(fit_naive(history, keys), periods, keys)


def moving_average(history: DataFrame, periods: int, window: int = 7, keys: Sequence[str] = ("segment",)) -> DataFrame:
    """The mean of the last ``window`` known values, repeated."""
    return project_level(fit_moving_average(history, window, keys), periods, keys)


def seasonal_naive(history: DataFrame, periods: int, season: int = 7, keys: Sequence[str] = ("segment",)) -> DataFrame:
    """The value of the same position in the last full season, by date; null
    when that day is not known."""
    return project_seasonal_naive(fit_seasonal_naive(history, season, keys), periods, keys)


def linear_trend(history: DataFrame, periods: int, keys: Sequence[str] = ("segment",)) -> DataFrame:
    """Least-squares line through the history, continued."""
    return project_linear_trend(fit_linear_trend(history, keys), periods, keys)


def rolling_naive(history: DataFrame, keys: Sequence[str] = ("segment",), lag: int = 1) -> DataFrame:
    """One-step forecasts inside the history: the value ``lag`` rows earlier."""
    return history.select(*keys, "ds", F.lag("y", lag).over(days(keys)).alias("yhat")).filter(
        F.col("yhat").isNotNull()
    )


def by_horizon(forecasts: DataFrame, horizons: Sequence[int], keys: Sequence[str] = ("segment", "model")) -> DataFrame:
    """One copy of the first ``h`` forecast days for every horizon ``h``."""
    if any(h < 1 for h in horizons):
        raise ValueError("every horizon must be at least one day")
    step = F.row_number().over(W.partitionBy(*keys).orderBy("ds"))
    reached = F.filter(F.array(*[F.lit(int(h)) for h in horizons]), lambda h: h >= F.col("_step"))
    return (
        forecasts.withColumn("_step", step).withColumn("horizon_days", F.explode(reached)).drop("_step")
    )


def mark_preliminary(forecasts: DataFrame, history: DataFrame, as_of: str, hours: int = 48, keys: Sequence[str] = ("segment",)) -> DataFrame:
    """``is_preliminary``: the history of the segment ends too long before
    ``as_of``."""
    newest = history.groupBy(*keys).agg(F.max("ds").cast("timestamp").alias("_newest"))
    edge = F.lit(as_of).cast("timestamp") - F.make_dt_interval(hours=F.lit(hours))
    joined = forecasts.join(newest, list(keys), "left")
    return joined.withColumn("is_preliminary", F.coalesce(F.col("_newest") < edge, F.lit(True))).drop("_newest")
