"""From cost records to ranked models, for all segments in one run."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlens.models import arima, boosted, seasonal, stored
from costlens.models.stored import MODELS, ModelOptions
from costlens.operators.aggregate import segment_daily_costs
from costlens.operators.evaluate import METRICS, best_model, compare_models
from costlens.operators.prepare import densify, fill_missing, split_by_fraction
from costlens.operators.quality import quality_report
from costlens.operators.versions import VersionTables, version_tags
from costlens.session import materialise

log = logging.getLogger(__name__)

HORIZONS = (30, 90, 180, 365)


@dataclass
class TrainingResult:
    quality: DataFrame
    daily: DataFrame
    forecasts: DataFrame
    comparison: DataFrame
    best: DataFrame
    coefficients: DataFrame | None = None
    arima_models: DataFrame | None = None
    boosted_model: boosted.BoostedModel | None = None
    failures: dict[str, str] = field(default_factory=dict)
    options: ModelOptions = ModelOptions()
    # Rows without a day belong to no series: their number and cost.
    undated: DataFrame | None = None


def segment_series(records: DataFrame, levels: Sequence[str] = ("total", "category")) -> DataFrame:
    """``segment, ds, y`` without gaps. The frame holds one row per segment and
    day and is checkpointed, because every model reads it."""
    daily = segment_daily_costs(fill_missing(records)).filter(F.col("segment_level").isin(*levels))
    # Regions get a prefix, and so does a category named like another kind of segment.
    mistaken = (F.col("segment") == "Total") | F.col("segment").rlike(r"\||^region:|^category:")
    name = (
        F.when(F.col("segment_level") == "region", F.concat(F.lit("region:"), "segment"))
        .when((F.col("segment_level") == "category") & mistaken, F.concat(F.lit("category:"), "segment"))
        .otherwise(F.col("segment"))
    )
    series = daily.select(name.alias("segment"), F.col("usage_date").alias("ds"), F.col("daily_cost").alias("y"))
    return materialise(densify(series.filter(F.col("ds").isNotNull())))


def train(
    records: DataFrame,
    as_of: str,
    models: Sequence[str] = MODELS,
    levels: Sequence[str] = ("total", "category"),
    seasonal_options: seasonal.SeasonalOptions = seasonal.SeasonalOptions(),
    arima_options: arima.ArimaOptions = arima.ArimaOptions(),
    boosted_options: boosted.BoostedOptions = boosted.BoostedOptions(),
    train_fraction: float = 0.7,
    validation_fraction: float = 0.15,
) -> TrainingResult:
    """Fit the models on training and validation days, forecast the test days,
    compare by date.

    A model that cannot be fitted is reported in ``failures`` and left out.
    """
    unknown = set(models) - set(MODELS)
    if unknown:
        raise ValueError(f"unknown models: {', '.join(sorted(unknown))}")
    daily = segment_series(records, levels)
    split = split_by_fraction(daily, train_fraction, validation_fraction)
    history = split.filter(F.col("split") != "test").drop("split")
    test = split.filter(F.col("split") == "test").drop("split")
    # One number: the longest test period.
    periods = test.groupBy("segment").count().agg(F.max("count")).first()[0]
    if periods is None:
        raise ValueError("the history is too short for a test period")

    frames: dict[str, DataFrame] = {}
    failures: dict[str, str] = {}
    options = ModelOptions(seasonal=seasonal_options, arima=arima_options, boosted=boosted_options)
    result = TrainingResult(quality_report(records, as_of), daily, daily, daily, daily, failures=failures, options=options, undated=undated_rows(records))

    def seasonal_forecast() -> DataFrame:
        result.coefficients = materialise(seasonal.fit(history, options=seasonal_options))
        out = seasonal.predict(result.coefficients, test, interval_width=seasonal_options.interval_width)
        return out.select("segment", "ds", "yhat", "yhat_lower", "yhat_upper")

    def arima_forecast() -> DataFrame:
        result.arima_models = materialise(arima.fit(history, options=arima_options))
        return arima.predict(result.arima_models, periods)

    def boosted_forecast() -> DataFrame:
        # From the same last day as the others: no test day sees another.
        result.boosted_model = boosted.fit(history, boosted_options, horizon=periods)
        return boosted.project(result.boosted_model)

    def baseline_forecast(kind: str) -> DataFrame:
        return stored.fit(kind, history, (periods,), options).forecast((periods,))

    makers = {
        "naive": lambda: baseline_forecast("naive"),
        "seasonal_naive": lambda: baseline_forecast("seasonal_naive"),
        "linear_trend": lambda: baseline_forecast("linear_trend"),
        "seasonal": seasonal_forecast,
        "arima": arima_forecast,
        "boosted": boosted_forecast,
    }
    for name in (m for m in MODELS if m in models):
        try:
            # Run here, so that a model that fails ends alone.
            frames[name] = materialise(stored.forecast_columns(makers[name]()))
        except Exception as error:  # noqa: BLE001 - one model must not end the run
            log.warning("%s failed: %s", name, error)
            failures[name] = str(error)

    stacked = None
    for name, frame in frames.items():
        tagged = frame.withColumn("model", F.lit(name))
        stacked = tagged if stacked is None else stacked.unionByName(tagged)
    if stacked is None:
        raise ValueError(f"no model could be fitted: {failures}")
    result.forecasts = materialise(stacked)
    # One row per segment and model; read again by every later step.
    result.comparison = materialise(compare_models(result.forecasts, test))
    result.best = best_model(result.comparison)
    return result


def undated_rows(records: DataFrame, date_col: str = "usage_date", cost_col: str = "cost_in_billing_currency") -> DataFrame:
    """``rows, cost`` of the records without a day, which no series can hold."""
    return records.filter(F.col(date_col).isNull()).agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(cost_col), F.lit(0.0)).cast("double").alias("cost")
    )


def fit_best(result: TrainingResult, horizons: Sequence[int] = HORIZONS) -> dict[str, stored.FittedModel]:
    """The model that won in each segment, fitted again to all its days with the options
    of the training run. One fit per kind serves all segments that chose it."""
    chosen = materialise(result.best.select("segment", "model"))
    models = {}
    for row in chosen.select("model").distinct().orderBy("model").collect():
        mine = result.daily.join(chosen.filter(F.col("model") == row["model"]).select("segment"), "segment", "left_semi")
        models[row["model"]] = stored.fit(row["model"], mine, horizons, result.options)
    return models


def register_best(
    result: TrainingResult,
    tables: VersionTables,
    at: str,
    horizons: Sequence[int] = HORIZONS,
    prefix: str = "cost/",
    data_version: str = "1",
) -> str:
    """Fit, store and register the best model of every segment; returns the version.

    The models of one kind lie in one folder, which all their segments name as path. A
    version row per segment carries kind, metrics and tags. All rows have one number.
    """
    spark = result.daily.sparkSession
    root = f"{tables.root}/models/{uuid.uuid4().hex}"
    models = fit_best(result, horizons)
    for kind, model in models.items():
        model.save(spark, f"{root}/{kind}")
    last = result.daily.groupBy("segment").agg(F.max("ds").alias("training_date"))
    metrics = F.map_from_arrays(F.array(*[F.lit(m) for m in METRICS]), F.array(*[F.col(m).cast("double") for m in METRICS]))
    rows = result.best.join(last, "segment").select(
        F.concat(F.lit(prefix), "segment").alias("name"),
        F.col("model").alias("model_type"),
        F.col("segment").alias("category"),
        metrics.alias("metrics"),
        F.concat(F.lit(f"{root}/"), "model").alias("path"),
        "training_date",
        F.lit(data_version).alias("data_version"),
        F.lit(at).alias("created_at"),
    )
    return tables.register_all(version_tags(rows), at)
