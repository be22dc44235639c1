"""Split-conformal forecast intervals from the errors of rolling origins.

Every day of a series is an origin: what a baseline would have forecast from it is known
without refitting, so its errors at a step are one shifted difference. A mergeable sketch
per segment and step keeps their quantile; the interval around a forecast is that far
wide. Nothing is assumed about the distribution of the errors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from costlens.functions.nulls import nan_to_null
from costlens.operators.prepare import days

# Steps at which errors are measured; a step between two of them takes the longer one's.
STEPS = (1, 2, 4, 7, 14, 21, 28, 42, 60, 90, 120, 180, 270, 365)
SKETCH = 4096  # errors that a sketch holds exactly; beyond it ranks are off by 0.1 % at most


def rolling_errors(
    history: DataFrame, model: str, steps: Sequence[int] = STEPS, season: int = 7, keys: Sequence[str] = ("segment",)
) -> DataFrame:
    """``keys, ds, step, error``: absolute errors of a baseline ``step`` days before ``ds``.

    Days without a known value, and pairs of rows that are not so many days apart, give
    no error. A series is sorted once for all steps.
    """
    order, y, day = days(keys), nan_to_null(F.col("y")), F.unix_date("ds")
    frame = history.select(*keys, "ds", y.alias("y"))

    def before(k: int, column: str) -> Column:
        apart = F.datediff("ds", F.lag("ds", k).over(order))
        return F.when(apart == k, F.lag(column, k).over(order))

    if model == "naive":
        told = {s: before(s, "y") for s in steps}
    elif model == "seasonal_naive":
        told = {s: before(-(-s // season) * season, "y") for s in steps}
    elif model == "linear_trend":
        # The line through all days up to each origin; days count from the first one.
        first = F.min(day).over(W.partitionBy(*keys))
        frame = frame.withColumn("_x", (day - first).cast("double"))
        past = order.rowsBetween(W.unboundedPreceding, 0)
        frame = frame.withColumns({"_slope": F.regr_slope("y", "_x").over(past), "_start": F.regr_intercept("y", "_x").over(past)})
        told = {s: before(s, "_start") + before(s, "_slope") * F.col("_x") for s in steps}
    else:
        raise ValueError(f"no rolling origins for {model}")
    errors = [F.struct(F.lit(int(s)).alias("step"), F.abs(F.col("y") - yhat).alias("error")) for s, yhat in told.items()]
    # The windows are computed before the rows are spread over the steps.
    return frame.withColumn("_errors", F.array(*errors)).select(*keys, "ds", F.inline("_errors")).filter(nan_to_null(F.col("error")).isNotNull())


def conformal_radius(errors: DataFrame, by: Sequence[str], width: float, sketch: int = SKETCH) -> DataFrame:
    """``by, n, radius``: the error whose rank among ``n`` is ``ceil((n + 1) * width)``, or
    the largest one if there are too few.

    New errors of the same kind stay below it with a probability of at least ``width``.
    Errors are merged on the map side into one sketch per group.
    """
    held = errors.groupBy(*by).agg(
        F.count("error").alias("n"), F.max("error").alias("_largest"), F.kll_sketch_agg_double("error", F.lit(sketch)).alias("_sketch")
    )
    # With an infinite error more, the wanted one stands at the rank ``width`` of n + 1.
    infinite = errors.sparkSession.range(1).agg(F.kll_sketch_agg_double(F.lit(float("inf")), F.lit(sketch)).alias("s")).scalar()
    at = F.kll_sketch_get_quantile_double(F.kll_sketch_merge_double("_sketch", infinite), F.lit(float(width)))
    return held.filter("n > 0").select(*by, "n", F.least(at, "_largest").alias("radius"))


def radii(history: DataFrame, model: str, width: float, season: int = 7, keys: Sequence[str] = ("segment",)) -> DataFrame:
    """``keys, radii``: the radius of every step with errors, in order of steps."""
    found = conformal_radius(rolling_errors(history, model, STEPS, season, keys), [*keys, "step"], width)
    return found.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("step", "radius"))).alias("radii"))


def radius_at(step: Column) -> Column:
    """The radius of the next measured step. Beyond the last one errors are taken to grow
    with the square root of the step, as those of a random walk do; without any errors the
    radius is infinite."""
    longer = F.filter("radii", lambda r: r["step"] >= step)
    last = F.try_element_at("radii", F.lit(-1))
    grown = last["radius"] * F.sqrt(step / last["step"])
    return F.coalesce(F.get(longer, F.lit(0))["radius"], grown, F.lit(float("inf")))


def with_bounds(forecasts: DataFrame, state: DataFrame, keys: Sequence[str] = ("segment",)) -> DataFrame:
    """Forecasts (``keys, ds, yhat``) with bounds; ``state`` has ``keys, last, radii``."""
    joined = forecasts.join(state.select(*keys, "last", "radii"), list(keys))
    reach = radius_at(F.datediff("ds", "last"))
    return joined.select(*keys, "ds", "yhat", (F.col("yhat") - reach).alias("yhat_lower"), (F.col("yhat") + reach).alias("yhat_upper"))
