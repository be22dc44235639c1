"""Forecasts of all segments by their best model, for several horizons."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlens.models import baseline, stored
from costlens.models.stored import MODELS, FittedModel, ModelOptions
from costlens.operators.versions import PRODUCTION, VersionTables
from costlens.plans.training import HORIZONS
from costlens.session import materialise


def project(models: Iterable[FittedModel], as_of: str, horizons: Sequence[int] = HORIZONS, late_hours: int = 48) -> DataFrame:
    """``segment, model, ds, yhat, yhat_lower, yhat_upper, horizon_days, is_preliminary``
    of fitted models, each for its own segments."""
    out = None
    for model in models:
        frame = model.forecast(horizons).withColumn("model", F.lit(model.kind))
        out = frame if out is None else out.unionByName(frame)
    if out is None:
        raise ValueError("no model to forecast with")
    out = materialise(out)
    # The history of a segment ends on the day before its first forecast.
    ends = out.groupBy("segment").agg(F.date_sub(F.min("ds"), 1).alias("ds"))
    return baseline.mark_preliminary(out, ends, as_of, late_hours)


def forecast(
    daily: DataFrame,
    best: DataFrame,
    as_of: str,
    horizons: Sequence[int] = HORIZONS,
    models: Sequence[str] = MODELS,
    late_hours: int = 48,
    options: ModelOptions = ModelOptions(),
) -> DataFrame:
    """Fit and forecast in one go.

    ``best`` is ``segment, model``. Every model sees only the history of the
    segments that chose it, all of them at once. The boosted model is fitted once
    per horizon, so that a near day is not forecast from features as old as the
    longest horizon.
    """
    chosen = best.select("segment", "model")
    fitted = []
    for name in models:
        mine = daily.join(chosen.filter(F.col("model") == name).select("segment"), "segment", "left_semi")
        if not mine.isEmpty():
            fitted.append(stored.fit(name, mine, horizons, options))
    return project(fitted, as_of, horizons, late_hours)


def forecast_stored(
    tables: VersionTables,
    as_of: str,
    stage: str = PRODUCTION,
    horizons: Sequence[int] = HORIZONS,
    late_hours: int = 48,
    prefix: str = "cost/",
) -> DataFrame:
    """Forecasts of the registered models in a stage, without any fitting.

    Each segment uses the newest version of its model. Models of one kind that were
    stored together are loaded and run together; the driver sees their folders only, a
    few per training run that still has a model in the stage.
    """
    spark = tables.spark
    found = tables.models_in(stage).filter(F.col("name").startswith(prefix)).select(F.col("category").alias("segment"), "path")
    paths = [r["path"] for r in found.select("path").distinct().orderBy("path").collect()]
    if not paths:
        raise ValueError(f"no model in stage {stage}")
    models = [FittedModel.load(spark, path).only(found.filter(F.col("path") == path).select("segment")) for path in paths]
    return project(models, as_of, horizons, late_hours)
