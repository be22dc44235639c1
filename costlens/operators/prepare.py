"""Missing values, outliers, gaps, chronological splits, model input frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from costlens.functions.checks import within
from costlens.functions.nulls import clean, is_missing, nan_to_null, present
from costlens.operators.aggregate import CATEGORY, TARGET
from costlens.operators.attach import attach
from costlens.operators.order_stats import exact_quantiles

NUMERIC_FILL = (TARGET, "quantity", "effective_price")
CATEGORICAL_FILL = ("meter_category", "resource_location", "plan_name")


def days(keys: Sequence[str] = ("segment",), date_col: str = "ds"):
    """Window over the days of one segment; at most one row per calendar day."""
    return W.partitionBy(*keys).orderBy(date_col)


# ---- missing values -------------------------------------------------------


def fill_missing(
    df: DataFrame,
    numeric: Sequence[str] = NUMERIC_FILL,
    categorical: Sequence[str] = CATEGORICAL_FILL,
    tags: Sequence[str] = ("tags",),
) -> DataFrame:
    """Measures to 0.0, categories to ``Unknown``, tag documents to ``{}``."""
    fills = {name: F.coalesce(clean(df, name), F.lit(0.0)) for name in present(numeric, df)}
    fills |= {name: F.coalesce(F.col(name), F.lit("Unknown")) for name in present(categorical, df)}
    fills |= {name: F.coalesce(F.col(name), F.lit("{}")) for name in present(tags, df)}
    return df.withColumns(fills) if fills else df


def fill_median(daily: DataFrame, value_col: str = "y", keys: Sequence[str] = ("segment",)) -> DataFrame:
    """Missing values of a daily series to the median of their segment."""
    middle = daily.groupBy(*keys).agg(F.median(clean(daily, value_col)).alias("_median"))
    match = [F.col(f"d.{k}").eqNullSafe(F.col(f"m.{k}")) for k in keys]
    joined = daily.alias("d").join(middle.alias("m"), match, "left").select("d.*", "m._median")
    return joined.withColumn(value_col, F.coalesce(clean(joined, value_col), F.col("_median"))).drop("_median")


def missing_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows where any of the columns is null or NaN."""
    condition = F.lit(False)
    for name in present(columns, df):
        condition = condition | is_missing(df, name)
    return df.filter(condition)


# ---- outliers -------------------------------------------------------------


def flag_outliers(
    df: DataFrame,
    value_col: str = "y",
    method: str = "p99",
    keys: Sequence[str] = ("segment",),
    exact: bool = True,
    factor: float | None = None,
    raw: bool = False,
) -> DataFrame:
    """Add ``is_outlier`` (runs jobs for the statistics).

    ``p99``: strictly above the 99th percentile. ``iqr``: outside the quartiles
    by ``factor`` (1.5) times their distance. ``zscore``: more than ``factor``
    (3) sample standard deviations from the mean; no spread means no outlier.
    A null value gets a null flag under ``p99`` and ``iqr``, false under
    ``zscore``. ``exact=False`` takes approximate percentiles. ``raw=True`` says
    that the rows are raw records and not a daily series; exact percentiles are
    then narrowed by a sketch first.
    """
    value = clean(df, value_col)
    if method == "zscore":
        stats = df.groupBy(*keys).agg(F.avg(value).alias("_mean"), F.stddev_samp(value).alias("_std"))
        distance = F.abs(F.col("_value") - F.col("_mean"))
        flag = F.coalesce(
            (F.col("_std") > 0) & (distance > F.lit(3.0 if factor is None else factor) * F.col("_std")), F.lit(False)
        )
    elif method in ("p99", "iqr"):
        probabilities = [0.99] if method == "p99" else [0.25, 0.75]
        if exact:
            stats = exact_quantiles(df.withColumn("_value", value), "_value", probabilities, keys, narrow=raw)
        else:
            stats = df.groupBy(*keys).agg(
                F.percentile_approx(value, [float(p) for p in probabilities], 10000).alias("quantiles")
            )
        if method == "p99":
            flag = F.col("_value") > F.col("quantiles")[0]
        else:
            low, high = F.col("quantiles")[0], F.col("quantiles")[1]
            reach = F.lit(1.5 if factor is None else factor) * (high - low)
            flag = (F.col("_value") < low - reach) | (F.col("_value") > high + reach)
    else:
        raise ValueError(f"unknown outlier method: {method}")
    helper = [name for name in stats.columns if name not in keys]
    joined = attach(df.withColumn("_value", value), stats, keys)
    return joined.withColumn("is_outlier", flag).drop("_value", *helper)


def treat_outliers(
    df: DataFrame, value_col: str = "y", treatment: str = "flag", keys: Sequence[str] = ("segment",)
) -> DataFrame:
    """``flag`` keeps the rows, ``cap`` limits the value to the 99th percentile
    and ``remove`` drops the flagged rows."""
    if treatment == "flag":
        return flag_outliers(df, value_col, "p99", keys)
    if treatment == "remove":
        return flag_outliers(df, value_col, "p99", keys).filter(~F.coalesce(F.col("is_outlier"), F.lit(False))).drop(
            "is_outlier"
        )
    if treatment == "cap":
        bounds = exact_quantiles(df.withColumn(value_col, clean(df, value_col)), value_col, [0.99], keys)
        joined = attach(df, bounds, keys)
        capped = F.when(
            F.col(value_col) > F.col("quantiles")[0], F.col("quantiles")[0]
        ).otherwise(F.col(value_col))
        return joined.withColumn(value_col, capped).drop("quantiles")
    raise ValueError(f"unknown outlier treatment: {treatment}")


# ---- gaps -----------------------------------------------------------------


def densify(
    daily: DataFrame,
    keys: Sequence[str] = ("segment",),
    date_col: str = "ds",
    value_cols: Sequence[str] = ("y",),
    fill: float | None = 0.0,
) -> DataFrame:
    """Every calendar day between the first and last day of each segment.

    Added days carry ``fill`` (null when it is None) and ``is_filled``.
    """
    spine = (
        daily.groupBy(*keys)
        .agg(F.min(date_col).alias("_from"), F.max(date_col).alias("_to"))
        .filter(F.col("_from").isNotNull())
        .select(*keys, F.explode(F.sequence("_from", "_to", F.expr("interval 1 day"))).alias(date_col))
    )
    match = [F.col(f"s.{k}").eqNullSafe(F.col(f"d.{k}")) for k in (*keys, date_col)]
    known = daily.select(*keys, date_col, *value_cols).withColumn("_known", F.lit(True))
    joined = spine.alias("s").join(known.alias("d"), match, "left")
    values = []
    for name in value_cols:
        column = F.col(f"d.{name}")
        if fill is not None:
            column = F.when(F.col("d._known").isNull(), F.lit(float(fill))).otherwise(F.coalesce(column, F.lit(float(fill))))
        values.append(column.alias(name))
    return joined.select(
        *[F.col(f"s.{k}").alias(k) for k in (*keys, date_col)], *values, F.col("d._known").isNull().alias("is_filled")
    )


def forward_fill(
    daily: DataFrame, value_col: str = "y", keys: Sequence[str] = ("segment",), date_col: str = "ds"
) -> DataFrame:
    """Null values to the last known value before them."""
    so_far = days(keys, date_col).rowsBetween(W.unboundedPreceding, 0)
    return daily.withColumn(value_col, F.last(clean(daily, value_col), ignorenulls=True).over(so_far))


def interpolate(
    daily: DataFrame, value_col: str = "y", keys: Sequence[str] = ("segment",), date_col: str = "ds"
) -> DataFrame:
    """Null values on the straight line between their neighbours in time.

    Leading and trailing nulls stay null.
    """
    before = days(keys, date_col).rowsBetween(W.unboundedPreceding, 0)
    after = days(keys, date_col).rowsBetween(0, W.unboundedFollowing)
    known = F.when(F.col("_y").isNotNull(), F.struct(F.col(date_col).alias("d"), F.col("_y").alias("y")))
    framed = (
        daily.withColumn("_y", clean(daily, value_col))
        .withColumn("_known", known)
        .withColumn("_left", F.last("_known", ignorenulls=True).over(before))
        .withColumn("_right", F.first("_known", ignorenulls=True).over(after))
    )
    span = F.datediff(F.col("_right.d"), F.col("_left.d"))
    step = F.datediff(F.col(date_col), F.col("_left.d"))
    line = F.col("_left.y") + (F.col("_right.y") - F.col("_left.y")) * F.try_divide(step.cast("double"), span.cast("double"))
    return framed.withColumn(value_col, F.coalesce(F.col("_y"), line)).drop("_y", "_known", "_left", "_right")


# ---- chronological splits -------------------------------------------------


def split_by_fraction(
    daily: DataFrame,
    train: float = 0.7,
    validation: float = 0.15,
    keys: Sequence[str] = ("segment",),
    date_col: str = "ds",
) -> DataFrame:
    """Label the days of every segment ``train``, ``validation`` or ``test``.

    Cuts are ``floor(n * train)`` and that plus ``floor(n * validation)`` in
    double arithmetic.
    """
    if not (0 < train < 1 and 0 <= validation < 1 and train + validation <= 1):
        raise ValueError("fractions must be positive and sum to at most one")
    size = F.count(F.lit(1)).over(W.partitionBy(*keys))
    train_end = F.floor(size * F.lit(float(train)))
    return _label(daily, train_end, train_end + F.floor(size * F.lit(float(validation))), keys, date_col)


def split_boosted(
    daily: DataFrame,
    test: float = 0.2,
    validation: float = 0.1,
    keys: Sequence[str] = ("segment",),
    date_col: str = "ds",
) -> DataFrame:
    """Cuts counted from the end: ``floor(n * (1 - test - validation))`` and
    ``floor(n * (1 - test))``."""
    size = F.count(F.lit(1)).over(W.partitionBy(*keys))
    return _label(
        daily,
        F.floor(size * F.lit(1.0 - test - validation)),
        F.floor(size * F.lit(1.0 - test)),
        keys,
        date_col,
    )


def _label(daily: DataFrame, train_end: Column, validation_end: Column, keys: Sequence[str], date_col: str) -> DataFrame:
    position = F.row_number().over(days(keys, date_col))
    label = (
        F.when(F.col("_position") <= F.col("_train_end"), "train")
        .when(F.col("_position") <= F.col("_validation_end"), "validation")
        .otherwise("test")
    )
    return (
        daily.withColumns({"_position": position, "_train_end": train_end, "_validation_end": validation_end})
        .withColumn("split", label)
        .drop("_position", "_train_end", "_validation_end")
    )


def split_by_months(
    daily: DataFrame,
    test_months: int = 3,
    validation_months: int = 3,
    keys: Sequence[str] = ("segment",),
    date_col: str = "ds",
) -> DataFrame:
    """The last months of every segment are test, those before validation."""
    within("the test months", test_months, 1)
    within("the validation months", validation_months, 1)
    newest = F.max(date_col).over(W.partitionBy(*keys))
    day = F.col(date_col)
    label = (
        F.when(day > F.add_months(F.col("_newest"), -test_months), "test")
        .when(day > F.add_months(F.col("_newest"), -(test_months + validation_months)), "validation")
        .otherwise("train")
    )
    return daily.withColumn("_newest", newest).withColumn("split", label).drop("_newest")


def split_records(
    records: DataFrame, train: float = 0.7, validation: float = 0.15, date_col: str = "usage_date", tie_cols: Sequence[str] = ()
) -> DataFrame:
    """Chronological split of raw rows, ``floor`` cuts as in
    ``split_by_fraction``, ties inside a day ordered by ``tie_cols``.

    No row is sorted or moved. Each cut is narrowed down to one row key by
    counts only: first per day, then by a hash prefix inside the one day that
    holds the cut, then by row key inside that prefix. The labels are a
    comparison of every row with the two keys. Equal keys are one unit and fall
    on the earlier side of a cut; rows without a date get no label.
    """
    keys = list(tie_cols) or records.columns
    day = F.to_date(date_col)
    key = F.md5(F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]))
    rows = records.filter(day.isNotNull())
    # One row per calendar day.
    per_day = rows.groupBy(day.alias("unit")).agg(F.count(F.lit(1)).alias("n"))
    size = per_day.agg(F.sum("n")).scalar()
    first = F.floor(size * F.lit(float(train)))
    second = first + F.floor(size * F.lit(float(validation)))

    def locate(counts: DataFrame, target: Column) -> Column:
        """The unit that holds a rank, and the rank inside it."""
        so_far = F.sum("n").over(W.partitionBy(F.lit(0)).orderBy("unit").rowsBetween(W.unboundedPreceding, 0))
        return (
            counts.withColumn("_cum", so_far)
            .filter(F.col("_cum") >= target)
            .agg(F.min(F.struct("unit", (target - F.col("_cum") + F.col("n")).alias("rest"))))
            .scalar()
        )

    def up_to(rank: Column) -> Column:
        """Rows on or before the row key that holds the one-based rank. The hash
        is computed for rows of the one day only."""
        cut_day = locate(per_day, rank)
        count_by = lambda df, unit: df.groupBy(unit.alias("unit")).agg(F.count(F.lit(1)).alias("n"))
        in_day = rows.filter(day == cut_day["unit"])
        prefix = F.substring(key, 1, 5)
        cut_prefix = locate(count_by(in_day, prefix), cut_day["rest"])
        in_prefix = in_day.filter(prefix == cut_prefix["unit"])
        cut_key = locate(count_by(in_prefix, key), cut_prefix["rest"])
        return (day < cut_day["unit"]) | ((day == cut_day["unit"]) & (key <= cut_key["unit"]))

    label = (
        F.when(day.isNull(), F.lit(None).cast("string"))
        .when(up_to(first), "train")
        .when(up_to(second), "validation")
        .otherwise("test")
    )
    return records.withColumn("split", label)


# ---- model inputs ---------------------------------------------------------


def series(df: DataFrame, segment: Column | str, date_col: str = "usage_date", value_col: str = "daily_cost") -> DataFrame:
    """A daily frame as ``segment, ds, y``."""
    name = F.col(segment) if isinstance(segment, str) else segment
    return df.select(name.alias("segment"), F.to_date(date_col).alias("ds"), F.col(value_col).cast("double").alias("y"))


def positive_series(daily: DataFrame, keys: Sequence[str] = ("segment",)) -> DataFrame:
    """``keys, ds, y`` with positive values only (NaN is not positive here)."""
    return daily.filter((F.col("y") > 0) & ~F.isnan("y")).select(*keys, "ds", "y")


def complete_series(daily: DataFrame, keys: Sequence[str] = ("segment",)) -> DataFrame:
    """``keys, ds, y`` without null and NaN values."""
    return daily.filter(nan_to_null(F.col("y")).isNotNull()).select(*keys, "ds", "y")


def by_category(df: DataFrame, categories: Sequence[str], category_col: str = CATEGORY) -> DataFrame:
    """Rows of the configured categories, with their name as ``segment``."""
    return df.filter(F.col(category_col).isin(*categories)).withColumn("segment", F.col(category_col))


def log_target(daily: DataFrame, value_col: str = "y", out_col: str = "y_log") -> DataFrame:
    return daily.withColumn(out_col, F.log1p(value_col))


def unlog_target(daily: DataFrame, value_col: str = "y_log", out_col: str = "y") -> DataFrame:
    return daily.withColumn(out_col, F.expm1(value_col))


def difference(
    daily: DataFrame,
    order: int = 1,
    seasonal_lag: int | None = None,
    value_col: str = "y",
    out_col: str = "y_diff",
    keys: Sequence[str] = ("segment",),
    date_col: str = "ds",
) -> DataFrame:
    """``order`` first differences, after one seasonal difference if asked for."""
    window = days(keys, date_col)
    frame = daily.withColumn(out_col, F.col(value_col))
    if seasonal_lag:
        frame = frame.withColumn(out_col, F.col(out_col) - F.lag(out_col, seasonal_lag).over(window))
    for _ in range(order):
        frame = frame.withColumn(out_col, F.col(out_col) - F.lag(out_col, 1).over(window))
    return frame


def standardise(
    df: DataFrame, columns: Sequence[str], split_col: str = "split", fit_on: str = "train", keys: Sequence[str] = ()
) -> DataFrame:
    """Centre and scale by mean and population deviation of the fitting split.

    A column without spread is only centred. With ``keys`` one job runs.
    """
    stats = []
    for name in columns:
        fitted = F.when(F.col(split_col) == fit_on, F.col(name))
        stats += [F.avg(fitted).alias(f"_mean_{name}"), F.stddev_pop(fitted).alias(f"_std_{name}")]
    joined = attach(df, df.groupBy(*keys).agg(*stats), keys)
    scaled = {
        name: (F.col(name) - F.col(f"_mean_{name}"))
        / F.when(F.col(f"_std_{name}") > 0, F.col(f"_std_{name}")).otherwise(F.lit(1.0))
        for name in columns
    }
    return joined.withColumns(scaled).drop(*[f"_{kind}_{name}" for name in columns for kind in ("mean", "std")])


def stratified_sample(
    df: DataFrame, fraction: float, strata_col: str = CATEGORY, key_cols: Sequence[str] = (), buckets: int = 10_000
) -> DataFrame:
    """A repeatable share of every stratum, chosen by a hash of the row key."""
    keys = list(key_cols) or df.columns
    return df.filter(F.pmod(F.xxhash64(strata_col, *keys), F.lit(buckets)) < int(fraction * buckets))
