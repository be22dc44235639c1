"""Boosted regression trees over calendar, lag and rolling features.

One model serves all segments; the segment enters as indicators. The trees are
MLlib's, so fitting runs on the cluster over all daily rows. Calls named ``fit``
or ``search`` run jobs.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import product

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from costlens.functions.checks import within
from costlens.models.baseline import future_dates
from costlens.models.intervals import conformal_radius
from costlens.operators.attach import attach
from costlens.operators.evaluate import align_on_date, metrics
from costlens.operators.features import (
    LAGS,
    WINDOWS,
    fill_features,
    lag_features,
    rolling_features,
    temporal_features,
)
from costlens.operators.prepare import days, split_boosted
from costlens.session import materialise

CALENDAR = (
    "Year", "Month", "Day", "DayOfWeek", "DayOfYear", "WeekOfYear", "Quarter", "IsWeekend", "IsMonthStart",
    "IsMonthEnd", "IsQuarterStart", "IsQuarterEnd", "Month_sin", "Month_cos", "DayOfWeek_sin", "DayOfWeek_cos",
    "DayOfYear_sin", "DayOfYear_cos",
)


@dataclass(frozen=True)
class BoostedOptions:
    n_estimators: int = 100
    max_depth: int = 6
    learning_rate: float = 0.1
    subsample: float = 0.8
    colsample: float = 0.8
    early_stopping_tolerance: float = 0.001
    test: float = 0.2
    validation: float = 0.1
    seed: int = 42
    # Share of the last days that a direct model leaves out to measure its errors.
    calibration: float = 0.1

    def __post_init__(self):
        within("n_estimators", self.n_estimators, 1)
        within("max_depth", self.max_depth, 1, 20)
        for name in ("learning_rate", "subsample", "colsample"):
            if not 0 < getattr(self, name) <= 1:
                raise ValueError(f"{name} must lie in (0, 1]")

    def regressor(self, validation_col: str | None = None) -> GBTRegressor:
        trees = GBTRegressor(
            featuresCol="features",
            labelCol="y",
            predictionCol="yhat",
            maxIter=self.n_estimators,
            maxDepth=self.max_depth,
            stepSize=self.learning_rate,
            subsamplingRate=self.subsample,
            featureSubsetStrategy=str(self.colsample) if self.colsample < 1 else "all",
            lossType="squared",
            seed=self.seed,
            validationTol=self.early_stopping_tolerance,
        )
        return trees.setValidationIndicatorCol(validation_col) if validation_col else trees


SEGMENT = ("segment_mean", "segment_std", "segment_trend")


@dataclass
class BoostedModel:
    """Trees, their features and the statistics of the segments.

    A direct model (``fit_direct``) also has its horizon, ``tail``, the last days of
    every series that its forecasts look back to, and ``radius``, half the width of the
    interval of each segment.
    """

    trees: GBTRegressionModel
    features: list[str]
    statistics: DataFrame
    horizon: int | None = None
    tail: DataFrame | None = None
    radius: DataFrame | None = None

    def save(self, path: str) -> None:
        """Everything that prediction needs, below one path."""
        self.trees.write().overwrite().save(f"{path}/trees")
        self.statistics.write.mode("overwrite").parquet(f"{path}/statistics")
        named = self.statistics.sparkSession.createDataFrame([(self.features, self.horizon)], "features array<string>, horizon int")
        named.write.mode("overwrite").parquet(f"{path}/features")
        if self.tail is not None:
            self.tail.write.mode("overwrite").parquet(f"{path}/tail")
            self.radius.write.mode("overwrite").parquet(f"{path}/radius")

    @classmethod
    def load(cls, spark, path: str) -> BoostedModel:
        named = spark.read.parquet(f"{path}/features").first()
        tail, radius = (None if named["horizon"] is None else spark.read.parquet(f"{path}/{part}") for part in ("tail", "radius"))
        trees = GBTRegressionModel.load(f"{path}/trees")
        return cls(trees, list(named["features"]), spark.read.parquet(f"{path}/statistics"), named["horizon"], tail, radius)


def assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")


def feature_rows(daily: DataFrame, keys: Sequence[str] = ("segment",), lags=LAGS, windows=WINDOWS) -> DataFrame:
    """Features known the evening before: rolling frames end one day earlier,
    and changes that contain the day itself are left out. Missing values are 0."""
    frame = temporal_features(daily, "ds")
    frame = lag_features(frame, "y", lags, keys)
    frame = rolling_features(frame, "y", windows, keys, exclude_current=True)
    names = [c for c in frame.columns if c.startswith(("y_lag_", "y_rolling_"))]
    return fill_features(frame, names)


def segment_statistics(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Level, spread and trend of every series on its training days; they tell
    segments apart whatever their number."""
    day = F.unix_date("ds").cast("double")
    y = F.col("y").cast("double")
    trained = rows.filter((F.col("split") == "train") & F.col("y").isNotNull() & ~F.isnan(y))
    return materialise(
        trained.groupBy(*keys).agg(
            F.avg(y).alias("segment_mean"), F.stddev_pop(y).alias("segment_std"), F.regr_slope(y, day).alias("segment_trend")
        )
    )


def with_statistics(rows: DataFrame, statistics: DataFrame) -> DataFrame:
    """``rows`` with the statistics of their segment, zero for an unseen one."""
    keys = [c for c in statistics.columns if c not in SEGMENT]
    return fill_features(attach(rows, statistics, keys), list(SEGMENT))


def _feature_names(frame: DataFrame) -> list[str]:
    history = [c for c in frame.columns if c.startswith(("y_lag_", "y_rolling_"))]
    return [*CALENDAR, *history, *SEGMENT]


def labelled_rows(daily: DataFrame, options: BoostedOptions, keys: Sequence[str] = ("segment",)) -> DataFrame:
    """Features of the whole series, then the chronological split, so that the
    first test days still see their past."""
    return split_boosted(feature_rows(daily, keys), options.test, options.validation, keys)


def fit(
    daily: DataFrame,
    options: BoostedOptions = BoostedOptions(),
    keys: Sequence[str] = ("segment",),
    horizon: int | None = None,
    width: float = 0.95,
) -> BoostedModel:
    """Fit on the training days, with early stopping on the validation days; with a
    ``horizon``, fit a direct model of that many days ahead."""
    if horizon is not None:
        return fit_direct(daily, horizon, options, keys, width=width)
    return _fit_rows(labelled_rows(daily, options, keys), options, keys)


def _fit_rows(rows: DataFrame, options: BoostedOptions, keys: Sequence[str]) -> BoostedModel:
    statistics = segment_statistics(rows, keys)
    frame = with_statistics(rows, statistics)
    names = _feature_names(rows)
    used = frame.filter(F.col("split").isin("train", "validation") & F.col("y").isNotNull()).withColumn(
        "is_validation", F.col("split") == "validation"
    )
    # Written once; the trees read it at every level.
    vectors = materialise(assembler(names).transform(used).select("features", F.col("y").cast("double").alias("y"), "is_validation"))
    early = options.validation > 0
    trees = options.regressor("is_validation" if early else None).fit(vectors)
    return BoostedModel(trees, names, statistics)


def predict(model: BoostedModel, rows: DataFrame, keys: Sequence[str] = ("segment",)) -> DataFrame:
    """``keys, ds, yhat``. A feature column the rows lack counts as zero."""
    frame = with_statistics(rows, model.statistics)
    aligned = frame.withColumns({c: F.lit(0) for c in model.features if c not in frame.columns})
    return model.trees.transform(assembler(model.features).transform(aligned)).select(*keys, "ds", "yhat")


def feature_importance(model: BoostedModel, spark, limit: int | None = None) -> DataFrame:
    """``feature, importance``, largest first; as many rows as features."""
    values = model.trees.featureImportances.toArray()
    rows = [(name, float(value)) for name, value in zip(model.features, values)]
    ranked = spark.createDataFrame(rows, "feature string, importance double").orderBy(F.col("importance").desc(), "feature")
    return ranked.limit(limit) if limit else ranked


def grid_search(
    daily: DataFrame,
    grid: Mapping[str, Sequence],
    options: BoostedOptions = BoostedOptions(),
    keys: Sequence[str] = ("segment",),
    metric: str = "rmse",
) -> tuple[BoostedOptions, list[dict]]:
    """Try every option combination, fitted on the training days and scored on
    the validation days; the split is chronological, never random."""
    rows = materialise(labelled_rows(daily, options, keys))
    results = []
    for values in product(*grid.values()):
        chosen = dict(zip(grid, values))
        tried = BoostedOptions(**{**options.__dict__, **chosen, "validation": 0.0})
        model = _fit_rows(rows.filter(F.col("split") == "train"), tried, keys)
        test = rows.filter(F.col("split") == "validation")
        scored = metrics(align_on_date(predict(model, test, keys), test.select(*keys, "ds", "y"), keys), ())
        results.append({**chosen, metric: scored.select(metric).first()[0]})
    # A score that cannot be computed never wins.
    best = min(results, key=lambda r: math.inf if r[metric] is None or math.isnan(r[metric]) else r[metric])
    return BoostedOptions(**{**options.__dict__, **{k: best[k] for k in grid}}), results


def learning_curve(model: BoostedModel, rows: DataFrame, spark) -> DataFrame:
    """``trees, train_error, validation_error``: squared error per number of
    trees on both splits."""
    frame = assembler(model.features).transform(with_statistics(rows.filter(F.col("y").isNotNull()), model.statistics)).withColumn(
        "y", F.col("y").cast("double")
    )
    errors = [
        model.trees.evaluateEachIteration(frame.filter(F.col("split") == split), "squared")
        for split in ("train", "validation")
    ]
    return spark.createDataFrame(
        [(i + 1, float(a), float(b)) for i, (a, b) in enumerate(zip(*errors))],
        "trees int, train_error double, validation_error double",
    )


def direct_rows(
    history: DataFrame, horizon: int, keys: Sequence[str] = ("segment",), windows: Sequence[int] = WINDOWS
) -> tuple[DataFrame, int]:
    """Feature rows of the history and of the ``horizon`` days after it, marked
    ``future`` in ``split``, and the days that the features look back. No feature is
    younger than ``horizon`` days."""
    ahead = future_dates(history, horizon, "D", keys).select(*keys, "ds", F.lit(None).cast("double").alias("y"), F.lit("future").alias("split"))
    window = days(keys)
    lags = (horizon, horizon + 1, horizon + 6, horizon + 29)
    columns = {f"y_lag_{k}": F.lag("y", k).over(window) for k in lags}
    for w in windows:
        columns[f"y_rolling_mean_{w}"] = F.avg("y").over(window.rowsBetween(-(horizon + w - 1), -horizon))
    past = history.withColumn("split", F.when(F.col("y").isNull(), "unknown").otherwise("train"))
    rows = temporal_features(past.unionByName(ahead)).withColumns(columns)
    return fill_features(rows, list(columns)), max(*lags, horizon + max(windows, default=0))


def fit_direct(
    daily: DataFrame,
    horizon: int,
    options: BoostedOptions = BoostedOptions(),
    keys: Sequence[str] = ("segment",),
    windows: Sequence[int] = WINDOWS,
    width: float = 0.95,
) -> BoostedModel:
    """One model whose features are at least ``horizon`` days old, so that no forecast
    feeds another, and the days that its forecasts look back to.

    The trees see no day of the last ``options.calibration`` share of a series; there
    each forecast is one from an origin ``horizon`` days before, and its errors give the
    split-conformal interval of the segment. All steps share it, as their features are of
    one age. Without such a share, or such days, bounds are infinite.
    """
    if horizon < 1:
        raise ValueError("horizon must be at least one day")
    history = daily.select(*keys, "ds", F.col("y").cast("double").alias("y"))
    rows, reach = direct_rows(history, horizon, keys, windows)
    if options.calibration > 0:
        days_known = F.sum(F.when(F.col("split") == "train", 1)).over(W.partitionBy(*keys))
        place = F.sum(F.when(F.col("split") == "train", 1)).over(days(keys))
        held = (F.col("split") == "train") & (place > F.floor(days_known * F.lit(1.0 - options.calibration))) & (days_known > 1)
        rows = rows.withColumn("split", F.when(held, "calibration").otherwise(F.col("split")))
    rows = materialise(rows.filter("split <> 'future'"))
    model = _fit_rows(rows, BoostedOptions(**{**options.__dict__, "validation": 0.0}), keys)
    measured = rows.filter(F.col("split") == "calibration")
    errors = predict(model, measured, keys).join(measured.select(*keys, "ds", "y"), [*keys, "ds"])
    radius = conformal_radius(errors.withColumn("error", F.abs(F.col("y") - F.col("yhat"))), keys, width)
    newest = F.row_number().over(days(keys).orderBy(F.col("ds").desc()))
    tail = history.withColumn("_age", newest).filter(F.col("_age") <= reach).drop("_age")
    return BoostedModel(model.trees, model.features, model.statistics, horizon, materialise(tail), materialise(radius))


def project(model: BoostedModel, keys: Sequence[str] = ("segment",)) -> DataFrame:
    """``keys, ds, yhat, yhat_lower, yhat_upper`` of the days after the history of a
    direct model."""
    windows = [int(name.rsplit("_", 1)[1]) for name in model.features if name.startswith("y_rolling_mean_")]
    rows, _ = direct_rows(model.tail, model.horizon, keys, windows)
    told = predict(model, rows.filter(F.col("split") == "future"), keys).join(model.radius, list(keys), "left")
    reach = F.coalesce("radius", F.lit(float("inf")))
    return told.select(*keys, "ds", "yhat", (F.col("yhat") - reach).alias("yhat_lower"), (F.col("yhat") + reach).alias("yhat_upper"))


def direct_forecast(
    daily: DataFrame,
    horizon: int,
    options: BoostedOptions = BoostedOptions(),
    keys: Sequence[str] = ("segment",),
    windows: Sequence[int] = WINDOWS,
) -> DataFrame:
    """Forecast the next ``horizon`` days with one model whose features are at
    least ``horizon`` days old, so no forecast feeds another."""
    return project(fit_direct(daily, horizon, options, keys, windows), keys)
