"""Residual diagnostics by segment: moments, autocorrelation, normality."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from costlens.functions.nulls import nan_to_null
from costlens.functions.probability import chi2_sf, chi2_sf_even
from costlens.operators.prepare import days

ALPHA = 0.05


def residual_moments(
    residuals: DataFrame, value_col: str = "residual", keys: Sequence[str] = ("segment",)
) -> DataFrame:
    value = nan_to_null(F.col(value_col))
    return residuals.groupBy(*keys).agg(
        F.avg(value).alias("residual_mean"), F.stddev_samp(value).alias("residual_std")
    )


def autocorrelation(
    residuals: DataFrame,
    lags: int = 10,
    value_col: str = "residual",
    keys: Sequence[str] = ("segment",),
    date_col: str = "ds",
) -> DataFrame:
    """``keys, lag, acf, n`` for lags one to ``lags``, over known values in date
    order. All lags come from one sort of the daily frame."""
    known = residuals.select(*keys, date_col, nan_to_null(F.col(value_col)).alias("_r")).filter(F.col("_r").isNotNull())
    centred = known.withColumn("_c", F.col("_r") - F.avg("_r").over(W.partitionBy(*keys)))
    window = days(keys, date_col)
    lagged = centred.select(*keys, "_c", *[F.lag("_c", k).over(window).alias(f"_l{k}") for k in range(1, lags + 1)])
    sums = lagged.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("_c") * F.col("_c")).alias("_ss"),
        *[F.sum(F.col("_c") * F.col(f"_l{k}")).alias(f"_s{k}") for k in range(1, lags + 1)],
    )
    entries = F.array(
        *[
            F.struct(F.lit(k).alias("lag"), F.try_divide(F.col(f"_s{k}"), F.col("_ss")).alias("acf"))
            for k in range(1, lags + 1)
        ]
    )
    return sums.select(*keys, "n", F.explode(entries).alias("e")).select(*keys, "e.lag", "e.acf", "n")


def ljung_box(
    residuals: DataFrame,
    lags: int = 10,
    value_col: str = "residual",
    keys: Sequence[str] = ("segment",),
    date_col: str = "ds",
) -> DataFrame:
    """Statistic, p-value and white-noise flag over ``lags`` lags."""
    acf = autocorrelation(residuals, lags, value_col, keys, date_col)
    n = F.col("n").cast("double")
    total = F.sum(F.try_divide(F.col("acf") * F.col("acf"), n - F.col("lag")))
    q = acf.groupBy(*keys).agg(F.max(n).alias("_n"), total.alias("_sum")).withColumn(
        "statistic", F.col("_n") * (F.col("_n") + 2.0) * F.col("_sum")
    )
    tail = chi2_sf_even(F.col("statistic"), lags) if lags % 2 == 0 else chi2_sf(F.col("statistic"), F.lit(lags))
    return q.withColumn("pvalue", tail).withColumn("is_white_noise", F.col("pvalue") > ALPHA).drop("_n", "_sum")


def jarque_bera(residuals: DataFrame, value_col: str = "residual", keys: Sequence[str] = ("segment",)) -> DataFrame:
    """Normality by skewness and kurtosis, for any number of rows."""
    value = nan_to_null(F.col(value_col))
    moments = residuals.groupBy(*keys).agg(
        F.count(value).alias("n"), F.skewness(value).alias("_skew"), F.kurtosis(value).alias("_kurt")
    )
    statistic = F.col("n") / F.lit(6.0) * (F.col("_skew") * F.col("_skew") + F.col("_kurt") * F.col("_kurt") / F.lit(4.0))
    return (
        moments.withColumn("statistic", statistic)
        .withColumn("pvalue", F.exp(-F.col("statistic") / F.lit(2.0)))
        .withColumn("is_normal", F.col("pvalue") > ALPHA)
        .drop("_skew", "_kurt")
    )
