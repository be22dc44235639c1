"""Calendar, lag, rolling-window, change and categorical features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlens.functions.calendar import temporal_columns
from costlens.functions.nulls import clean, is_floating
from costlens.operators.attach import BROADCAST_ROWS
from costlens.operators.prepare import days

LAGS = (1, 2, 3, 7, 14, 30)
WINDOWS = (3, 7, 14, 30)
EPSILON = 1e-8
CATEGORICAL = ("meter_category", "resource_location", "plan_name")


def temporal_features(df: DataFrame, date_col: str = "ds") -> DataFrame:
    """The calendar features of ``date_col``, Monday being day zero."""
    return df.withColumns(temporal_columns(F.to_date(date_col)))


def lag_features(
    daily: DataFrame, target: str = "y", lags: Sequence[int] = LAGS, keys: Sequence[str] = ("segment",), date_col: str = "ds"
) -> DataFrame:
    """``{target}_lag_{k}``: the value ``k`` rows earlier in the segment."""
    _positive(lags, "lag")
    window = days(keys, date_col)
    return daily.withColumns({f"{target}_lag_{k}": F.lag(target, k).over(window) for k in lags})


def rolling_features(
    daily: DataFrame,
    target: str = "y",
    windows: Sequence[int] = WINDOWS,
    keys: Sequence[str] = ("segment",),
    date_col: str = "ds",
    exclude_current: bool = False,
    measures: Sequence[str] = ("mean", "std", "max", "min"),
) -> DataFrame:
    """``{target}_rolling_{measure}_{w}`` over the last ``w`` rows.

    Null until ``w`` known values are in the frame. ``exclude_current`` shifts
    the frame one row back so that a feature never holds the day it predicts.
    """
    _positive(windows, "window")
    build = {"mean": F.avg, "std": F.stddev_samp, "max": F.max, "min": F.min}
    value = clean(daily, target)
    columns = {}
    for w in windows:
        frame = days(keys, date_col).rowsBetween(-w, -1) if exclude_current else days(keys, date_col).rowsBetween(-(w - 1), 0)
        full = F.count(value).over(frame) == w
        for measure in measures:
            columns[f"{target}_rolling_{measure}_{w}"] = F.when(full, build[measure](value).over(frame))
    return daily.withColumns(columns)


def derived_features(df: DataFrame, target: str = "y", quantity: str = "total_quantity") -> DataFrame:
    """Unit cost and changes against the lags 1, 7 and 30 that the frame has."""
    columns = {}
    if target in df.columns and quantity in df.columns:
        columns["CostPerUnit"] = F.try_divide(F.col(target), F.col(quantity) + F.lit(EPSILON))
    for lag, name in ((1, "DayOverDay"), (7, "WeekOverWeek"), (30, "MonthOverMonth")):
        if f"{target}_lag_{lag}" in df.columns:
            earlier = F.col(f"{target}_lag_{lag}")
            columns[f"{name}Change"] = F.col(target) - earlier
            if lag == 1:
                columns[f"{name}PctChange"] = F.try_divide(F.col(target) - earlier, earlier + F.lit(EPSILON)) * F.lit(100.0)
    return df.withColumns(columns) if columns else df


def year_over_year(
    daily: DataFrame, target: str = "y", keys: Sequence[str] = ("segment",), date_col: str = "ds"
) -> DataFrame:
    """Change against the same calendar day one year earlier, by date.

    On 29 February the day before it one year earlier is taken.
    """
    earlier = daily.select(*keys, F.col(date_col).alias("_day"), F.col(target).alias("y_last_year"))
    match = [F.col(f"d.{k}").eqNullSafe(F.col(f"e.{k}")) for k in keys]
    match.append(F.add_months(F.col(f"d.{date_col}"), -12) == F.col("e._day"))
    joined = daily.alias("d").join(earlier.alias("e"), match, "left").select("d.*", "e.y_last_year")
    return joined.withColumn("YearOverYearChange", F.col(target) - F.col("y_last_year"))


def model_features(
    daily: DataFrame,
    target: str = "y",
    quantity: str = "total_quantity",
    lags: Sequence[int] = LAGS,
    windows: Sequence[int] = WINDOWS,
    keys: Sequence[str] = ("segment",),
    date_col: str = "ds",
    exclude_current: bool = False,
) -> DataFrame:
    """Calendar, lag, rolling and derived features in one plan.

    All windows share one partitioning and one order, so Spark shuffles and
    sorts the daily frame once.
    """
    frame = temporal_features(daily, date_col)
    frame = lag_features(frame, target, lags, keys, date_col)
    frame = rolling_features(frame, target, windows, keys, date_col, exclude_current)
    return derived_features(frame, target, quantity)


def fill_features(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null and NaN features to zero."""
    zero = {
        name: F.coalesce(clean(df, name), F.lit(0.0) if is_floating(df, name) else F.lit(0)) for name in columns
    }
    return df.withColumns(zero)


def one_hot(df: DataFrame, levels: dict[str, Sequence[str]]) -> DataFrame:
    """``{column}_{level}`` indicators, the first sorted level dropped.

    ``levels`` is fixed when the model is fitted, so training and scoring frames
    get the same columns and an unseen level is all zeros.
    """
    columns = {}
    for name, values in levels.items():
        for value in sorted(values)[1:]:
            columns[f"{name}_{value}"] = F.coalesce((F.col(name) == value).cast("int"), F.lit(0))
    return df.withColumns(columns) if columns else df


def fit_levels(df: DataFrame, columns: Sequence[str] = CATEGORICAL, limit: int = 1000) -> dict[str, list[str]]:
    """Read the levels for ``one_hot``; runs a job. More than ``limit`` levels
    are refused: such a column belongs through ``top_levels`` first."""
    out = {}
    for name in columns:
        if name not in df.columns:
            continue
        found = [row[0] for row in df.select(name).filter(F.col(name).isNotNull()).distinct().limit(limit + 1).collect()]
        if len(found) > limit:
            raise ValueError(f"{name} has more than {limit} levels")
        out[name] = sorted(found)
    return out


def top_levels(
    df: DataFrame, column: str, n: int, out_col: str | None = None, other: str = "Other", rank_by: str | None = None
) -> DataFrame:
    """Keep the ``n`` most frequent (or costliest) levels, group the others.

    The kept levels are ``n`` rows at most, so their join side is broadcast up
    to a limit on ``n``.
    """
    weight = F.count(F.lit(1)) if rank_by is None else F.sum(rank_by)
    counted = df.filter(F.col(column).isNotNull()).groupBy(column).agg(weight.alias("_weight"))
    top = counted.orderBy(F.col("_weight").desc(), F.col(column)).limit(n).select(F.col(column).alias("_level"))
    side = F.broadcast(top) if n <= BROADCAST_ROWS else top
    joined = df.join(side, F.col(column) == F.col("_level"), "left")
    name = out_col or column
    kept = F.coalesce(F.col("_level"), F.lit(other))
    return joined.withColumn(name, kept).drop("_level")


def align_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exactly the training columns: missing ones as zero, extra ones dropped."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(0).alias(c) for c in columns])


def correlated_pairs(df: DataFrame, columns: Sequence[str], threshold: float = 0.95) -> DataFrame:
    """Feature pairs whose absolute Pearson correlation exceeds a threshold.

    One aggregate computes the coefficients of all pairs of the given names; its
    size grows with the number of features, never with the rows.
    """
    names = sorted(columns)
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]
    row = df.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    entries = F.array(
        *[
            F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), F.col(f"c{i}").alias("correlation"))
            for i, (a, b) in enumerate(pairs)
        ]
    )
    long = row.select(F.explode(entries).alias("p")).select("p.*")
    return long.filter(F.abs(F.col("correlation")) > threshold)


def _positive(values: Sequence[int], what: str) -> None:
    if any(v < 1 for v in values):
        raise ValueError(f"every {what} must be at least one")
