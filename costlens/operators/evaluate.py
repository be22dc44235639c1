"""Forecast accuracy, model comparison and ensembles on long frames.

A forecast frame is ``segment, model, ds, yhat``; actuals are ``segment, ds, y``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from costlens.functions.nulls import is_finite, nan_to_null

GROUP = ("segment", "model")
METRICS = ("rmse", "mae", "mape", "r2", "mae_percentage")
EPSILON = 1e-8
HORIZONS = (1, 7, 30, 90)


# ---- alignment ------------------------------------------------------------


def align_on_date(forecasts: DataFrame, actuals: DataFrame, keys: Sequence[str] = ("segment",)) -> DataFrame:
    """Inner join of forecasts and actuals on segment and day."""
    return forecasts.join(actuals, [*keys, "ds"], "inner")


def align_complete(forecasts: DataFrame, actuals: DataFrame, keys: Sequence[str] = ("segment",)) -> DataFrame:
    """As ``align_on_date``, without pairs that hold a null or NaN."""
    pairs = align_on_date(forecasts, actuals, keys)
    return pairs.filter(nan_to_null(F.col("y")).isNotNull() & nan_to_null(F.col("yhat")).isNotNull())


def align_by_position(
    forecasts: DataFrame, actuals: DataFrame, keys: Sequence[str] = ("segment",), model_col: str = "model"
) -> DataFrame:
    """Pair the n-th forecast with the n-th actual; the longer side is cut."""
    numbered = forecasts.withColumn(
        "position", F.row_number().over(W.partitionBy(*keys, model_col).orderBy("ds"))
    )
    targets = actuals.withColumn("position", F.row_number().over(W.partitionBy(*keys).orderBy("ds"))).select(
        *keys, "position", "y"
    )
    return numbered.join(targets, [*keys, "position"], "inner")


def finite_pairs(df: DataFrame, actual: str = "y", predicted: str = "yhat") -> DataFrame:
    return df.filter(is_finite(F.col(actual)) & is_finite(F.col(predicted)))


# ---- metrics --------------------------------------------------------------


def metric_columns(actual: str = "y", predicted: str = "yhat") -> list[Column]:
    """Aggregates over finite pairs; a group without any gives NaN metrics."""
    mask = is_finite(F.col(actual)) & is_finite(F.col(predicted))
    y = F.when(mask, F.col(actual).cast("double"))
    error = F.when(mask, F.col(actual).cast("double") - F.col(predicted).cast("double"))
    nan = F.lit(float("nan"))
    n = F.count(y)
    sse = F.sum(error * error)
    sst = F.var_pop(y) * n
    mae = F.avg(F.abs(error))
    mean = F.avg(y)
    r2 = (
        F.when(n < 2, nan)
        .when(sst > 0, F.lit(1.0) - F.try_divide(sse, sst))
        .when(sse == 0, F.lit(1.0))
        .otherwise(F.lit(0.0))
    )
    return [
        n.alias("n"),
        F.coalesce(F.sqrt(F.avg(error * error)), nan).alias("rmse"),
        F.coalesce(mae, nan).alias("mae"),
        F.coalesce(F.avg(F.abs(F.try_divide(error, y + F.lit(EPSILON)))) * F.lit(100.0), nan).alias("mape"),
        r2.alias("r2"),
        F.when(mean > 0, F.try_divide(mae, mean) * F.lit(100.0)).otherwise(nan).alias("mae_percentage"),
    ]


def metrics(pairs: DataFrame, keys: Sequence[str] = GROUP, actual: str = "y", predicted: str = "yhat") -> DataFrame:
    """One row per key: n, rmse, mae, mape, r2, mae_percentage."""
    return pairs.groupBy(*keys).agg(*metric_columns(actual, predicted))


def metrics_by_horizon(
    pairs: DataFrame, horizons: Sequence[int] = HORIZONS, keys: Sequence[str] = GROUP, date_col: str = "ds"
) -> DataFrame:
    """Metrics over the first ``h`` days; a horizon longer than the group is
    left out."""
    if any(h < 1 for h in horizons):
        raise ValueError("every horizon must be at least one day")
    position = F.row_number().over(W.partitionBy(*keys).orderBy(date_col))
    reached = F.filter(F.array(*[F.lit(int(h)) for h in horizons]), lambda h: h >= F.col("_position"))
    spread = (
        pairs.withColumn("_position", position)
        .withColumn("horizon", F.explode(reached))
    )
    return (
        spread.groupBy(*keys, "horizon")
        .agg(F.count(F.lit(1)).alias("_rows"), *metric_columns())
        .filter(F.col("_rows") == F.col("horizon"))
        .drop("_rows")
    )


def rounded_summary(measured: DataFrame, digits: int = 4) -> DataFrame:
    """Metrics rounded half to even."""
    return measured.withColumns({m: F.bround(m, digits) for m in METRICS if m in measured.columns})


def target_flags(measured: DataFrame, target_mape: float = 10.0, target_r2: float = 0.8) -> DataFrame:
    """``meets_mape_target`` and ``meets_r2_target``; NaN meets neither."""
    return measured.withColumns(
        {
            "meets_mape_target": F.coalesce(nan_to_null(F.col("mape")) < target_mape, F.lit(False)),
            "meets_r2_target": F.coalesce(nan_to_null(F.col("r2")) > target_r2, F.lit(False)),
        }
    )


def evaluate(
    forecasts: DataFrame,
    actuals: DataFrame,
    by: str = "date",
    target_mape: float = 10.0,
    target_r2: float = 0.8,
) -> DataFrame:
    """Metrics and target flags of every (segment, model)."""
    pairs = align_on_date(forecasts, actuals) if by == "date" else align_by_position(forecasts, actuals)
    return target_flags(metrics(pairs), target_mape, target_r2)


def interval_coverage(pairs: DataFrame, keys: Sequence[str] = GROUP) -> DataFrame:
    """Share of actuals inside ``[yhat_lower, yhat_upper]``."""
    inside = F.col("y").between(F.col("yhat_lower"), F.col("yhat_upper")).cast("double")
    return pairs.groupBy(*keys).agg(F.avg(inside).alias("coverage"))


# ---- comparison -----------------------------------------------------------


def average_rank(metric: str, descending: bool = False, keys: Sequence[str] = ("segment",)) -> Column:
    """Rank with ties sharing their mean position; NaN and null get no rank."""
    value = nan_to_null(F.col(metric))
    order = value.desc_nulls_last() if descending else value.asc_nulls_last()
    ties = F.count(F.lit(1)).over(W.partitionBy(*keys, value))
    return F.when(value.isNotNull(), F.rank().over(W.partitionBy(*keys).orderBy(order)) + (ties - 1) / F.lit(2.0))


def rank_models(measured: DataFrame, keys: Sequence[str] = ("segment",)) -> DataFrame:
    """Add the MAPE rank, the R2 rank and their mean."""
    ranked = measured.withColumns(
        {
            "mape_rank": average_rank("mape", keys=keys),
            "r2_rank": average_rank("r2", descending=True, keys=keys),
        }
    )
    return ranked.withColumn("overall_rank", (F.col("mape_rank") + F.col("r2_rank")) / F.lit(2.0))


def compare_models(forecasts: DataFrame, actuals: DataFrame, by: str = "date") -> DataFrame:
    """``evaluate`` for every model, ranked inside each segment."""
    return rank_models(evaluate(forecasts, actuals, by))


def best_model(measured: DataFrame, metric: str = "mape", keys: Sequence[str] = ("segment",)) -> DataFrame:
    """The best row per key: largest R2 or smallest error; NaN never wins and
    the model name breaks ties."""
    if metric not in METRICS:
        raise ValueError(f"unknown metric: {metric}")
    value = nan_to_null(F.col(metric))
    order = value.desc_nulls_last() if metric == "r2" else value.asc_nulls_last()
    position = F.row_number().over(W.partitionBy(*keys).orderBy(order, "model"))
    return measured.withColumn("_position", position).filter(F.col("_position") == 1).drop("_position")


def stack_models(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Forecast frames of several models as one long frame."""
    stacked = None
    for name, frame in frames.items():
        tagged = frame.withColumn("model", F.lit(name))
        stacked = tagged if stacked is None else stacked.unionByName(tagged, allowMissingColumns=True)
    if stacked is None:
        raise ValueError("no forecasts given")
    return stacked


def performance_weights(measured: DataFrame, keys: Sequence[str] = ("segment",)) -> DataFrame:
    """Weights inverse to the MAPE, summing to one per key. A perfect model
    counts with the smallest MAPE that is told from zero."""
    mape = nan_to_null(F.col("mape"))
    inverse = F.when(mape.isNotNull(), F.lit(1.0) / F.greatest(mape, F.lit(EPSILON)))
    total = F.sum("_inverse").over(W.partitionBy(*keys))
    return (
        measured.withColumn("_inverse", inverse)
        .withColumn("weight", F.try_divide(F.col("_inverse"), total))
        .select(*keys, "model", "weight")
    )


def ensemble(
    forecasts: DataFrame,
    weights: DataFrame | None = None,
    keys: Sequence[str] = ("segment",),
    by: str = "date",
) -> DataFrame:
    """Weighted mean of the models at every day (or position) they all reach.

    ``weights`` is ``[segment,] model, weight``; the sum of all weights given
    normalises them, and a model without a weight counts zero. Without weights
    the models count the same.
    """
    if by == "date":
        at = "ds"
        placed = forecasts
    else:
        at = "position"
        placed = forecasts.withColumn(at, F.row_number().over(W.partitionBy(*keys, "model").orderBy("ds")))
    members = forecasts.select(*keys, "model").distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias("_members"))
    if weights is None:
        weighted = placed.withColumns({"_weight": F.lit(1.0)}).join(members, list(keys)).withColumn(
            "_total", F.col("_members").cast("double")
        )
    else:
        shared = [k for k in keys if k in weights.columns]
        given = weights.select(*shared, "model", F.col("weight").cast("double").alias("_weight"))
        weighted = placed.join(given, [*shared, "model"], "left")
        if shared:
            totals = weights.groupBy(*shared).agg(F.sum("weight").cast("double").alias("_total"))
            weighted = weighted.join(totals, shared, "left")
        else:
            weighted = weighted.withColumn("_total", weights.agg(F.sum("weight").cast("double")).scalar())
        weighted = weighted.join(members, list(keys))
    share = F.coalesce(F.col("_weight"), F.lit(0.0)) / F.col("_total")
    return (
        weighted.groupBy(*keys, at)
        .agg(
            F.sum(F.col("yhat") * share).alias("yhat"),
            F.count(F.lit(1)).alias("_present"),
            F.max("_members").alias("_members"),
        )
        .filter(F.col("_present") == F.col("_members"))
        .select(*keys, at, "yhat")
    )


def sensitivity(base: DataFrame, scenarios: Mapping[str, DataFrame], actuals: DataFrame) -> DataFrame:
    """Metrics of a base forecast and of perturbed forecasts, by scenario."""
    frames = {"base": base, **scenarios}
    stacked = None
    for name, frame in frames.items():
        tagged = frame.select("segment", "ds", "yhat").withColumn("scenario", F.lit(name))
        stacked = tagged if stacked is None else stacked.unionByName(tagged)
    return metrics(align_on_date(stacked, actuals), ("segment", "scenario"))


def benchmark(measured: DataFrame, baseline: str, keys: Sequence[str] = ("segment",)) -> DataFrame:
    """Improvement of every model over a baseline model, in percent."""
    against = measured.filter(F.col("model") == baseline).select(
        *keys, F.col("rmse").alias("_rmse"), F.col("mape").alias("_mape")
    )
    joined = measured.join(against, list(keys), "left")
    gain = lambda name: F.try_divide(F.col(f"_{name}") - F.col(name), F.col(f"_{name}")) * F.lit(100.0)
    return joined.withColumns({"rmse_improvement_pct": gain("rmse"), "mape_improvement_pct": gain("mape")}).drop(
        "_rmse", "_mape"
    )


def challenge(
    measured: DataFrame, candidate: str, production: str, keys: Sequence[str] = ("segment",)
) -> DataFrame:
    """Candidate against production per key, with the winner by MAPE."""
    pick = lambda name, prefix: measured.filter(F.col("model") == name).select(
        *keys, *[F.col(m).alias(f"{prefix}_{m}") for m in ("mape", "rmse", "r2")]
    )
    pairs = pick(candidate, "candidate").join(pick(production, "production"), list(keys))
    better = nan_to_null(F.col("candidate_mape")) < nan_to_null(F.col("production_mape"))
    return pairs.withColumn("candidate_wins", F.coalesce(better, F.lit(False)))


# ---- scenarios ------------------------------------------------------------


def drop_days(daily: DataFrame, percent: int, key_cols: Sequence[str] = ("segment", "ds")) -> DataFrame:
    """Missing-data scenario: a repeatable share of the days is removed."""
    return daily.filter(F.pmod(F.xxhash64(*key_cols), F.lit(100)) >= percent)


def inflate_days(daily: DataFrame, percent: int, factor: float, key_cols: Sequence[str] = ("segment", "ds")) -> DataFrame:
    """Outlier scenario: a repeatable share of the days is multiplied."""
    chosen = F.pmod(F.xxhash64(*key_cols), F.lit(100)) < percent
    return daily.withColumn("y", F.when(chosen, F.col("y") * factor).otherwise(F.col("y")))


def delay_days(daily: DataFrame, delay: int, keys: Sequence[str] = ("segment",)) -> DataFrame:
    """Late-data scenario: the last ``delay`` days have not arrived yet."""
    newest = F.max("ds").over(W.partitionBy(*keys))
    return daily.withColumn("_newest", newest).filter(F.col("ds") <= F.date_sub("_newest", delay)).drop("_newest")
