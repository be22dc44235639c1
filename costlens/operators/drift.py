"""Distribution drift between a baseline and a current frame.

Both frames keep their rows on the cluster; a test sees value counts only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from costlens.functions.nulls import is_floating, nan_to_null
from costlens.functions.probability import chi2_sf, kolmogorov_pvalue, normal_two_sided
from costlens.operators.attach import attach
from costlens.operators.order_stats import cumulative_counts, exact_quantiles

ALPHA = 0.05
PSI_FLOOR = 1e-4


def describe_baseline(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean and sample deviation per column, in long form."""
    _require(df, columns)
    # One pass with three aggregates per column; only the one result row is turned.
    known = {c: nan_to_null(F.col(c)) if is_floating(df, c) else F.col(c).cast("double") for c in columns}
    rows = [
        F.struct(F.lit(c).alias("feature"), F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"))
        for c, x in known.items()
    ]
    return df.agg(F.array(*rows).alias("rows")).select(F.explode("rows").alias("r")).select("r.*").filter("n > 0")


def melt(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Numeric columns as ``(feature, value)`` rows without missing values."""
    entries = F.array(
        *[
            F.struct(
                F.lit(c).alias("feature"),
                (nan_to_null(F.col(c)) if is_floating(df, c) else F.col(c).cast("double")).alias("value"),
            )
            for c in columns
        ]
    )
    return df.select(F.explode(entries).alias("e")).select("e.*").filter(F.col("value").isNotNull())


def _samples(baseline: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    left = melt(baseline, columns).withColumns({"n_base": one, "n_cur": none})
    right = melt(current, columns).withColumns({"n_base": none, "n_cur": one})
    return left.unionByName(right)


def sample_counts(baseline: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Running value counts of both samples per feature (runs one job)."""
    _require(baseline, columns)
    _require(current, columns)
    return cumulative_counts(_samples(baseline, current, columns), "value", ["feature"], ["n_base", "n_cur"])


def _summary(samples: DataFrame) -> DataFrame:
    """Sizes, means and baseline deviation per feature, from a plain scan."""
    base = F.when(F.col("n_base") == 1, F.col("value"))
    current = F.when(F.col("n_cur") == 1, F.col("value"))
    return samples.groupBy("feature").agg(
        F.count(base).alias("n_baseline"),
        F.count(current).alias("n_current"),
        F.avg(base).alias("mean_baseline"),
        F.avg(current).alias("mean_current"),
        F.stddev_samp(base).alias("std_baseline"),
    )


def ks_drift(
    baseline: DataFrame, current: DataFrame, columns: Sequence[str], alpha: float = ALPHA
) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov test of every column, one row each.

    Columns that one of the frames lacks are skipped. ``drift_magnitude`` is the
    shift of the mean in baseline deviations, zero without spread.
    """
    shared = [c for c in columns if c in baseline.columns and c in current.columns]
    counts = sample_counts(baseline, current, shared)
    gap = F.abs(
        F.try_divide(F.col("cum_n_base"), F.col("total_n_base").cast("double"))
        - F.try_divide(F.col("cum_n_cur"), F.col("total_n_cur").cast("double"))
    )
    statistic = counts.groupBy("feature").agg(F.max(gap).alias("statistic"))
    magnitude = F.when(
        F.col("std_baseline") > 0, F.abs(F.col("mean_current") - F.col("mean_baseline")) / F.col("std_baseline")
    ).otherwise(F.lit(0.0))
    return (
        _summary(_samples(baseline, current, shared))
        .join(statistic, "feature")
        .withColumn("pvalue", kolmogorov_pvalue(F.col("statistic"), F.col("n_baseline"), F.col("n_current")))
        .withColumn("is_drift", F.col("pvalue") < alpha)
        .withColumn("drift_magnitude", magnitude)
    )


def distribution_drift(
    baseline: DataFrame, current: DataFrame, column: str, method: str = "ks", alpha: float = ALPHA
) -> DataFrame:
    """Drift of one column by ``ks`` (numeric) or ``chi2`` (categorical)."""
    _require(baseline, [column])
    _require(current, [column])
    if method == "ks":
        return ks_drift(baseline, current, [column], alpha)
    if method == "chi2":
        return chi2_drift(baseline, current, [column], alpha)
    raise ValueError(f"unknown drift method: {method}")


def chi2_drift(
    baseline: DataFrame, current: DataFrame, columns: Sequence[str], alpha: float = ALPHA
) -> DataFrame:
    """Chi-square test of homogeneity per categorical column, from the
    contingency table of its levels."""

    def levels(df: DataFrame, base: int) -> DataFrame:
        entries = F.array(
            *[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("level")) for c in columns]
        )
        return (
            df.select(F.explode(entries).alias("e"))
            .select("e.*")
            .filter(F.col("level").isNotNull())
            .withColumns({"b": F.lit(base), "c": F.lit(1 - base)})
        )

    table = (
        levels(baseline, 1)
        .unionByName(levels(current, 0))
        .groupBy("feature", "level")
        .agg(F.sum("b").alias("b"), F.sum("c").alias("c"))
    )
    totals = table.groupBy("feature").agg(
        F.sum("b").alias("_b"), F.sum("c").alias("_c"), (F.count(F.lit(1)) - 1).alias("dof")
    )
    both = F.col("b") + F.col("c")
    whole = (F.col("_b") + F.col("_c")).cast("double")
    expected_b, expected_c = F.try_divide(both * F.col("_b"), whole), F.try_divide(both * F.col("_c"), whole)
    term = F.try_divide(F.pow(F.col("b") - expected_b, F.lit(2.0)), expected_b) + F.try_divide(
        F.pow(F.col("c") - expected_c, F.lit(2.0)), expected_c
    )
    return (
        table.join(totals, "feature")
        .groupBy("feature", "dof")
        .agg(F.sum(term).alias("statistic"))
        .withColumn("pvalue", chi2_sf(F.col("statistic"), F.col("dof")))
        .withColumn("is_drift", F.col("pvalue") < alpha)
    )


def psi(baseline: DataFrame, current: DataFrame, columns: Sequence[str], buckets: int = 10) -> DataFrame:
    """Population stability index over baseline quantile buckets (runs jobs for
    the quantiles). Rows meet the cuts by broadcast, one row per column."""
    _require(baseline, columns)
    _require(current, columns)
    chances = [i / buckets for i in range(1, buckets)]
    cuts = exact_quantiles(melt(baseline, columns), "value", chances, ["feature"], narrow=True)
    placed = attach(_samples(baseline, current, columns), cuts, ["feature"])
    bucket = F.size(F.filter("quantiles", lambda q: q < F.col("value")))
    shares = placed.groupBy("feature", bucket.alias("bucket")).agg(F.sum("n_base").alias("b"), F.sum("n_cur").alias("c"))
    totals = shares.groupBy("feature").agg(F.sum("b").alias("_b"), F.sum("c").alias("_c"))
    return (
        shares.join(totals, "feature")
        .groupBy("feature")
        .agg(F.sum(psi_term(F.col("b"), F.col("_b"), F.col("c"), F.col("_c"))).alias("psi"))
    )


def psi_term(base: Column, base_total: Column, current: Column, current_total: Column) -> Column:
    floor = F.lit(PSI_FLOOR)
    p = F.greatest(F.coalesce(F.try_divide(current.cast("double"), current_total.cast("double")), F.lit(0.0)), floor)
    q = F.greatest(F.coalesce(F.try_divide(base.cast("double"), base_total.cast("double")), F.lit(0.0)), floor)
    return (p - q) * F.ln(p / q)


def mann_whitney(baseline: DataFrame, current: DataFrame, columns: Sequence[str], alpha: float = ALPHA) -> DataFrame:
    """Mann-Whitney U of the current sample, normal approximation with the tie
    correction, from running value counts."""
    counts = sample_counts(baseline, current, columns)
    ties = (F.col("n_base") + F.col("n_cur")).cast("double")
    before = (F.col("cum_n_base") + F.col("cum_n_cur")).cast("double") - ties
    middle = before + (ties + 1.0) / 2.0
    sums = counts.groupBy("feature").agg(
        F.sum("n_base").cast("double").alias("_n1"),
        F.sum("n_cur").cast("double").alias("_n2"),
        F.sum(F.col("n_cur") * middle).alias("_ranks"),
        F.sum(ties * ties * ties - ties).alias("_ties"),
    )
    n1, n2 = F.col("_n1"), F.col("_n2")
    n = n1 + n2
    u = F.col("_ranks") - n2 * (n2 + 1.0) / 2.0
    spread = F.sqrt(n1 * n2 / F.lit(12.0) * ((n + 1.0) - F.try_divide(F.col("_ties"), n * (n - 1.0))))
    return (
        sums.withColumn("u", u)
        .withColumn("z", F.coalesce(F.try_divide(F.col("u") - n1 * n2 / 2.0, spread), F.lit(0.0)))
        .withColumn("pvalue", normal_two_sided(F.col("z")))
        .withColumn("is_drift", F.col("pvalue") < alpha)
        .select("feature", "u", "z", "pvalue", "is_drift")
    )


def season_profile_shift(
    baseline: DataFrame, current: DataFrame, keys: Sequence[str] = ("segment",), date_col: str = "ds", value_col: str = "y"
) -> DataFrame:
    """PSI of the cost share by weekday between two periods."""

    def profile(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(*keys, F.weekday(date_col).alias("weekday")).agg(F.sum(value_col).alias(name))

    shares = profile(baseline, "b").join(profile(current, "c"), [*keys, "weekday"], "full")
    whole = W.partitionBy(*keys)
    return (
        shares.withColumns({"_b": F.sum("b").over(whole), "_c": F.sum("c").over(whole)})
        .groupBy(*keys)
        .agg(F.sum(psi_term(F.coalesce("b", F.lit(0.0)), F.col("_b"), F.coalesce("c", F.lit(0.0)), F.col("_c"))).alias("psi"))
    )


def trend_shift(
    baseline: DataFrame, current: DataFrame, keys: Sequence[str] = ("segment",), date_col: str = "ds", value_col: str = "y"
) -> DataFrame:
    """Slope per day of both periods and their difference."""

    def slope(df: DataFrame, name: str) -> DataFrame:
        day = F.unix_date(F.col(date_col)).cast("double")
        return df.groupBy(*keys).agg(F.regr_slope(F.col(value_col), day).alias(name))

    return (
        slope(baseline, "slope_baseline")
        .join(slope(current, "slope_current"), list(keys), "full")
        .withColumn("slope_change", F.col("slope_current") - F.col("slope_baseline"))
    )


def new_values(baseline: DataFrame, current: DataFrame, column: str) -> DataFrame:
    """Values of a column that the baseline never had, with their row count."""
    seen = baseline.select(F.col(column).alias("value")).filter(F.col("value").isNotNull()).distinct()
    now = current.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(
        F.count(F.lit(1)).alias("record_count")
    )
    return now.join(seen, "value", "left_anti")


def _require(df: DataFrame, columns: Sequence[str]) -> None:
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"columns not found: {', '.join(absent)}")
