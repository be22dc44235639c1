"""Seasonal-trend regression: piecewise linear trend, yearly and weekly Fourier
terms and holiday effects, ridge-fitted for every segment in parallel.

Only the small least-squares solve runs in Python, on one daily series per
group. Prediction is a column expression over the coefficient frame.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costlens.operators.evaluate import metric_columns

COEFFICIENTS = (
    "start date, span double, intercept double, slope double, hinges array<double>, deltas array<double>, "
    "yearly array<double>, weekly array<double>, holidays map<string,double>, sigma double, n long, multiplicative boolean"
)
YEAR, WEEK = 365.25, 7.0


@dataclass(frozen=True)
class SeasonalOptions:
    yearly: bool = True
    weekly: bool = True
    multiplicative: bool = True
    changepoint_prior_scale: float = 0.05
    seasonality_prior_scale: float = 10.0
    holidays_prior_scale: float = 10.0
    changepoints: int = 25
    changepoint_range: float = 0.8
    yearly_order: int = 10
    weekly_order: int = 3
    interval_width: float = 0.8

    def __post_init__(self):
        if min(self.changepoint_prior_scale, self.seasonality_prior_scale, self.holidays_prior_scale) <= 0:
            raise ValueError("prior scales must be positive")
        if not 0 < self.interval_width < 1:
            raise ValueError("interval width must lie between zero and one")


def _fourier(day: np.ndarray, period: float, order: int) -> np.ndarray:
    angle = 2 * math.pi * np.outer(day, np.arange(1, order + 1)) / period
    return np.hstack([np.sin(angle), np.cos(angle)])


def _solve(pdf: pd.DataFrame, options: SeasonalOptions) -> dict:
    """Penalised least squares on one series with columns ds, y, holiday."""
    pdf = pdf.sort_values("ds")
    when = pd.to_datetime(pdf["ds"])
    day = (when - pd.Timestamp("1970-01-01")).dt.days.to_numpy(float)
    y = pdf["y"].to_numpy(float)
    multiplicative = bool(options.multiplicative and (y > 0).all())
    target = np.log(y) if multiplicative else y
    span = max(day[-1] - day[0], 1.0)
    t = (day - day[0]) / span
    count = min(options.changepoints, max(len(y) - 2, 0))
    hinges = np.linspace(0, options.changepoint_range, count + 1)[1:] if count else np.empty(0)
    held = [() if h is None else tuple(h) for h in pdf["holiday"]] if "holiday" in pdf else []
    names = sorted({name for day_names in held for name in day_names})
    blocks = [
        np.column_stack([np.ones_like(t), t]),
        np.maximum(0.0, t[:, None] - hinges[None, :]),
        _fourier(day, YEAR, options.yearly_order if options.yearly else 0),
        _fourier(day, WEEK, options.weekly_order if options.weekly else 0),
        np.array([[float(h in day_names) for h in names] for day_names in held]) if names else np.empty((len(y), 0)),
    ]
    design = np.hstack(blocks)
    sizes = [b.shape[1] for b in blocks]
    level = float(np.std(target)) or 1.0
    noise = (0.1 * level) ** 2
    scale = level * np.concatenate(
        [
            np.full(sizes[0], 1e4),
            np.full(sizes[1], options.changepoint_prior_scale),
            np.full(sizes[2] + sizes[3], options.seasonality_prior_scale),
            np.full(sizes[4], options.holidays_prior_scale),
        ]
    )
    gram = design.T @ design + np.diag(noise / scale**2)
    beta = np.linalg.lstsq(gram, design.T @ target, rcond=None)[0]
    residual = target - design @ beta
    parts = np.split(beta, np.cumsum(sizes)[:-1])
    return {
        "start": when.iloc[0].date(),
        "span": span,
        "intercept": float(parts[0][0]),
        "slope": float(parts[0][1]),
        "hinges": hinges.tolist(),
        "deltas": parts[1].tolist(),
        "yearly": parts[2].tolist(),
        "weekly": parts[3].tolist(),
        "holidays": {h: float(b) for h, b in zip(names, parts[4])},
        "sigma": float(np.sqrt(np.mean(residual**2))),
        "n": len(y),
        "multiplicative": multiplicative,
    }


def fit(
    history: DataFrame,
    keys: Sequence[str] = ("segment",),
    options: SeasonalOptions = SeasonalOptions(),
    holidays: DataFrame | None = None,
) -> DataFrame:
    """One coefficient row per key. ``holidays`` is ``ds, holiday``."""
    frame = history.filter(F.col("y").isNotNull() & ~F.isnan("y")).select(*keys, "ds", "y")
    if holidays is not None:
        frame = _with_holidays(frame, holidays)
    names = list(keys)

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        row = {name: pdf[name].iloc[0] for name in names} | _solve(pdf, options)
        return pd.DataFrame([row])

    types = {f.name: f.dataType.simpleString() for f in frame.schema}
    schema = ", ".join(f"{name} {types[name]}" for name in names) + ", " + COEFFICIENTS
    return frame.groupBy(*names).applyInPandas(solve, schema)


def _with_holidays(frame: DataFrame, holidays: DataFrame) -> DataFrame:
    """All holiday names of each day as an array; days without one stay null."""
    named = holidays.filter("holiday IS NOT NULL").groupBy("ds").agg(F.array_sort(F.collect_set("holiday")).alias("holiday"))
    return frame.join(named, "ds", "left")


def _waves(coefficients: str, day: Column, period: float) -> Column:
    """Sum of sines and cosines; the array holds all sines, then all cosines."""
    order = (F.size(coefficients) / F.lit(2)).cast("int")
    indexed = F.transform(
        F.col(coefficients),
        lambda b, i: b
        * F.when(i < order, F.sin(day * (F.lit(2 * math.pi / period) * (i + 1)))).otherwise(
            F.cos(day * (F.lit(2 * math.pi / period) * (i - order + 1)))
        ),
    )
    return F.aggregate(indexed, F.lit(0.0), lambda a, b: a + b)


def predict(
    coefficients: DataFrame,
    dates: DataFrame,
    keys: Sequence[str] = ("segment",),
    holidays: DataFrame | None = None,
    interval_width: float = 0.8,
) -> DataFrame:
    """``keys, ds, yhat, yhat_lower, yhat_upper, trend, yearly, weekly, holidays``.

    Components are on the fitted scale: factors on ``exp(trend)`` when the fit is
    multiplicative.
    """
    z = NormalDist().inv_cdf(0.5 + interval_width / 2)
    frame = dates.select(*keys, "ds")
    frame = _with_holidays(frame, holidays) if holidays is not None else frame.withColumn("holiday", F.lit(None).cast("array<string>"))
    joined = frame.join(coefficients, list(keys), "inner")
    day = F.unix_date("ds").cast("double")
    t = F.datediff("ds", "start") / F.col("span")
    bend = F.aggregate(
        F.zip_with("hinges", "deltas", lambda h, d: d * F.greatest(F.lit(0.0), F.col("_t") - h)),
        F.lit(0.0),
        lambda a, b: a + b,
    )
    scored = joined.withColumn("_t", t).withColumns(
        {
            "_trend": F.col("intercept") + F.col("slope") * F.col("_t") + bend,
            "_yearly": _waves("yearly", day, YEAR),
            "_weekly": _waves("weekly", day, WEEK),
            "_holiday": F.coalesce(
                F.aggregate("holiday", F.lit(0.0), lambda total, name: total + F.coalesce(F.try_element_at(F.col("holidays"), name), F.lit(0.0))),
                F.lit(0.0),
            ),
        }
    )
    total = F.col("_trend") + F.col("_yearly") + F.col("_weekly") + F.col("_holiday")
    reach = F.lit(z) * F.col("sigma")
    back = lambda column: F.when(F.col("multiplicative"), F.exp(column)).otherwise(column)
    return scored.select(
        *keys,
        "ds",
        back(total).alias("yhat"),
        back(total - reach).alias("yhat_lower"),
        back(total + reach).alias("yhat_upper"),
        back(F.col("_trend")).alias("trend"),
        back(F.col("_yearly")).alias("yearly"),
        back(F.col("_weekly")).alias("weekly"),
        back(F.col("_holiday")).alias("holidays"),
    )


def components(forecasts: DataFrame, keys: Sequence[str] = ("segment",)) -> DataFrame:
    """The component columns of a forecast; one that is absent is null."""
    wanted = ("trend", "yearly", "weekly", "holidays")
    return forecasts.select(
        *keys,
        "ds",
        *[F.col(c) if c in forecasts.columns else F.lit(None).cast("double").alias(c) for c in wanted],
    )


# ---- rolling-origin cross-validation --------------------------------------


def fold_frame(
    history: DataFrame, initial: int = 180, period: int = 30, horizon: int = 30, keys: Sequence[str] = ("segment",)
) -> DataFrame:
    """Rows of every fold: ``keys, cutoff, role, ds, y``.

    Cutoffs go back from ``max - horizon`` by ``period`` days while they are not
    before ``min + initial``. Training rows are on or before the cutoff, test
    rows within ``horizon`` days after it. A row fans out to the folds of its own
    segment only.
    """
    bounds = history.groupBy(*keys).agg(F.min("ds").alias("_min"), F.max("ds").alias("_max"))
    newest, oldest = F.date_sub("_max", horizon), F.date_add("_min", initial)
    steps = F.floor(F.datediff(newest, oldest) / F.lit(float(period))).cast("int")
    cutoffs = bounds.filter(newest >= oldest).select(
        *keys, F.transform(F.sequence(F.lit(0), steps), lambda i: F.date_sub(newest, i * period)).alias("_cutoffs")
    )
    match = F.filter("_cutoffs", lambda c: F.col("ds") <= F.date_add(c, horizon))
    rows = history.join(cutoffs, list(keys)).select(*keys, "ds", "y", F.explode(match).alias("cutoff"))
    role = F.when(F.col("ds") <= F.col("cutoff"), "train").otherwise("test")
    return rows.select(*keys, "cutoff", role.alias("role"), "ds", "y")


def cross_validate(
    history: DataFrame,
    initial: int = 180,
    period: int = 30,
    horizon: int = 30,
    keys: Sequence[str] = ("segment",),
    options: SeasonalOptions = SeasonalOptions(),
) -> DataFrame:
    """Metrics and interval coverage per key, averaged over the folds. Every
    fold of every segment is a group of its own. A segment too short for a fold
    gets NaN metrics."""
    folds = fold_frame(history, initial, period, horizon, keys)
    by = [*keys, "cutoff"]
    fitted = fit(folds.filter(F.col("role") == "train"), by, options)
    test = folds.filter(F.col("role") == "test")
    scored = predict(fitted, test, by, interval_width=options.interval_width).join(test.select(*by, "ds", "y"), [*by, "ds"])
    inside = F.col("y").between(F.col("yhat_lower"), F.col("yhat_upper")).cast("double")
    per_fold = scored.groupBy(*by).agg(*metric_columns(), F.avg(inside).alias("coverage"))
    nan = F.lit(float("nan"))
    means = per_fold.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("folds"), *[F.avg(m).alias(m) for m in ("rmse", "mae", "mape", "coverage")]
    )
    every = history.select(*keys).distinct()
    return every.join(means, list(keys), "left").select(
        *keys,
        F.coalesce("folds", F.lit(0)).alias("folds"),
        *[F.coalesce(m, nan).alias(m) for m in ("rmse", "mae", "mape", "coverage")],
    )
