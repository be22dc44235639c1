"""Roll-ups of cost records: daily series, segment levels, distributions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from costlens.functions.calendar import hours_between, period_start
from costlens.functions.checks import within

TARGET = "cost_in_billing_currency"
DATE = "usage_date"
CATEGORY = "meter_category"
REGION = "resource_location"


def daily_costs(
    df: DataFrame,
    keys: Sequence[str] = (),
    date_col: str = DATE,
    cost_col: str = TARGET,
    quantity_col: str = "quantity",
    price_col: str = "effective_price",
) -> DataFrame:
    """One row per day and key: summed cost and quantity, unweighted mean price.

    Quantity and price are optional columns; their results are null without them.
    """
    return df.groupBy(F.to_date(date_col).alias("usage_date"), *keys).agg(
        F.sum(cost_col).alias("daily_cost"),
        F.sum(_optional(df, quantity_col)).alias("total_quantity"),
        F.avg(_optional(df, price_col)).alias("avg_rate"),
    )


def _optional(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("double")


def segment_daily_costs(
    df: DataFrame,
    category_col: str = CATEGORY,
    region_col: str = REGION,
    date_col: str = DATE,
    cost_col: str = TARGET,
    quantity_col: str = "quantity",
    price_col: str = "effective_price",
) -> DataFrame:
    """Daily series for the total, each category, each region and each pair.

    Raw rows are aggregated once to the finest grain; the grouping sets then
    expand that small frame and not the raw rows. The mean price is carried as
    sum and count so that it stays the mean over raw rows at every level.
    """
    finest = df.groupBy(
        F.to_date(date_col).alias("usage_date"),
        F.col(category_col).alias("category"),
        F.col(region_col).alias("region"),
    ).agg(
        F.sum(cost_col).alias("cost"),
        F.sum(_optional(df, quantity_col)).alias("quantity"),
        F.sum(_optional(df, price_col)).alias("price_sum"),
        F.count(_optional(df, price_col)).alias("price_count"),
    )
    day, category, region = F.col("usage_date"), F.col("category"), F.col("region")
    levels = finest.groupingSets(
        [[day], [day, category], [day, region], [day, category, region]], day, category, region
    ).agg(
        F.grouping("category").alias("no_category"),
        F.grouping("region").alias("no_region"),
        F.sum("cost").alias("daily_cost"),
        F.sum("quantity").alias("total_quantity"),
        F.try_divide(F.sum("price_sum"), F.sum("price_count")).alias("avg_rate"),
    )
    level = (
        F.when((F.col("no_category") == 1) & (F.col("no_region") == 1), "total")
        .when(F.col("no_region") == 1, "category")
        .when(F.col("no_category") == 1, "region")
        .otherwise("category_region")
    )
    unknown_category = F.coalesce("category", F.lit("Unknown"))
    unknown_region = F.coalesce("region", F.lit("Unknown"))
    segment = (
        F.when(F.col("segment_level") == "total", "Total")
        .when(F.col("segment_level") == "category", unknown_category)
        .when(F.col("segment_level") == "region", unknown_region)
        .otherwise(F.concat_ws("|", unknown_category, unknown_region))
    )
    return (
        levels.withColumn("segment_level", level)
        .withColumn("segment", segment)
        .select("segment_level", "segment", "usage_date", "daily_cost", "total_quantity", "avg_rate")
    )


def _with_whole(grouped: DataFrame) -> DataFrame:
    """Add the total over all groups. The subquery reads both aggregates of the
    grouped frame, so Spark runs that aggregation once and reuses its shuffle."""
    whole = grouped.agg(F.struct(F.sum("total_cost").alias("cost"), F.sum("record_count").alias("n"))).scalar()
    return grouped.withColumn("_whole", whole)


def distribution(df: DataFrame, key: str, cost_col: str = TARGET) -> DataFrame:
    """Record count, cost and cost share per value of ``key``."""
    grouped = df.groupBy(key).agg(F.count(F.lit(1)).alias("record_count"), F.sum(cost_col).alias("total_cost"))
    return (
        _with_whole(grouped)
        .withColumn("cost_share", F.try_divide(F.col("total_cost"), F.col("_whole.cost")))
        .drop("_whole")
    )


def region_share_deviation(
    df: DataFrame, expected: Mapping[str, float], region_col: str = REGION, cost_col: str = TARGET
) -> DataFrame:
    """Cost share per expected region against its weight."""
    for name, weight in expected.items():
        within(f"the weight of {name}", weight, 0.0, 1.0)
    weights = df.sparkSession.createDataFrame(
        [(name, float(weight)) for name, weight in expected.items()], "region string, expected_share double"
    )
    shares = distribution(df, region_col, cost_col).select(F.col(region_col).alias("region"), "cost_share")
    return (
        weights.join(shares, "region", "left")
        .withColumn("actual_share", F.coalesce("cost_share", F.lit(0.0)))
        .select(
            "region",
            "expected_share",
            "actual_share",
            F.abs(F.col("actual_share") - F.col("expected_share")).alias("deviation"),
        )
    )


def data_profile(df: DataFrame, date_col: str = DATE) -> DataFrame:
    """One row: record count and both ends of the date range."""
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.min(F.to_date(date_col)).alias("min_date"),
        F.max(F.to_date(date_col)).alias("max_date"),
    )


def data_availability(df: DataFrame, as_of: str, max_age_hours: float = 168.0, date_col: str = DATE) -> DataFrame:
    """One row: count, latest date, age at ``as_of`` and whether it is fresh."""
    within("the maximum age", max_age_hours, 0)
    age = hours_between(F.lit(as_of).cast("timestamp"), F.col("latest_date"))
    return (
        df.agg(F.count(F.lit(1)).alias("record_count"), F.max(F.to_date(date_col)).alias("latest_date"))
        .withColumn("hours_old", age)
        .withColumn("is_fresh", F.coalesce(F.col("hours_old") <= max_age_hours, F.lit(False)))
        .withColumn("is_available", F.col("record_count") > 0)
    )


def roll_up(
    daily: DataFrame, period: str, keys: Sequence[str] = ("segment",), date_col: str = "ds", value_col: str = "y"
) -> DataFrame:
    """Weekly (ISO, Monday) or monthly totals of a daily series."""
    start = period_start(F.col(date_col), period)
    return daily.groupBy(*keys, start.alias("period_start")).agg(
        F.sum(value_col).alias("period_total"), F.count(value_col).alias("days")
    )


def minimum_history(
    daily: DataFrame, months: int = 12, keys: Sequence[str] = ("segment",), date_col: str = "ds"
) -> DataFrame:
    """Length of history per segment in thirty-day months against a minimum."""
    within("the minimum history", months, 1)
    span = F.datediff(F.max(date_col), F.min(date_col)) / F.lit(30.0)
    return (
        daily.groupBy(*keys)
        .agg(F.min(date_col).alias("first_day"), F.max(date_col).alias("last_day"), span.alias("months_available"))
        .withColumn("has_minimum", F.col("months_available") >= float(months))
    )


def record_count_check(df: DataFrame, tolerance: float = 0.5, trailing: int = 7, date_col: str = DATE) -> DataFrame:
    """Daily record count against the mean of the preceding days.

    The window runs over one row per day, not over records.
    """
    frame = W.partitionBy(F.lit(0)).orderBy("usage_date").rowsBetween(-trailing, -1)
    expected = F.when(F.count("record_count").over(frame) == trailing, F.avg("record_count").over(frame))
    return (
        df.groupBy(F.to_date(date_col).alias("usage_date"))
        .agg(F.count(F.lit(1)).alias("record_count"))
        .withColumn("expected_count", expected)
        .withColumn(
            "is_unexpected",
            F.coalesce(
                F.abs(F.col("record_count") - F.col("expected_count")) > tolerance * F.col("expected_count"),
                F.lit(False),
            ),
        )
    )


def daily_limit_flag(daily: DataFrame, limit: float = 1_000_000.0, cost_col: str = "daily_cost") -> DataFrame:
    """Flag days whose cost is above a business limit."""
    return daily.withColumn("over_limit", F.col(cost_col) > F.lit(float(limit)))


def cost_by_tag(df: DataFrame, tags_col: str, cost_col: str, fill: str = "{}") -> DataFrame:
    """Cost per tag key and value; a missing tag document counts as empty."""
    pairs = F.from_json(F.coalesce(F.col(tags_col), F.lit(fill)), "map<string,string>")
    return (
        df.select(F.explode(pairs).alias("tag_key", "tag_value"), F.col(cost_col).alias("_cost"))
        .groupBy("tag_key", "tag_value")
        .agg(F.count(F.lit(1)).alias("record_count"), F.sum("_cost").alias("total_cost"))
    )


def top_drivers(df: DataFrame, driver_col: str, n: int, segment_col: str = CATEGORY, cost_col: str = TARGET) -> DataFrame:
    """The ``n`` most expensive drivers of every segment, name as tie-break.

    Spark turns the rank filter into a group limit before the shuffle, so every
    task sends at most ``n`` drivers per segment and a hot segment stays small.
    """
    grouped = df.groupBy(segment_col, driver_col).agg(F.sum(cost_col).alias("total_cost"))
    order = W.partitionBy(segment_col).orderBy(F.col("total_cost").desc(), F.col(driver_col))
    return grouped.withColumn("position", F.row_number().over(order)).filter(F.col("position") <= n)


def reconcile(
    ours: DataFrame,
    statement: DataFrame,
    period: str = "month",
    tolerance: float = 0.01,
    date_col: str = DATE,
    cost_col: str = TARGET,
) -> DataFrame:
    """Per-period totals of two sources side by side, with a tolerance flag."""

    def totals(df: DataFrame, name: str) -> DataFrame:
        start = period_start(F.to_date(date_col), period)
        return df.groupBy(start.alias("period_start")).agg(F.sum(cost_col).alias(name))

    difference = F.coalesce(F.col("our_total"), F.lit(0.0)) - F.coalesce(F.col("statement_total"), F.lit(0.0))
    reference = F.abs(F.coalesce(F.col("statement_total"), F.lit(0.0)))
    return (
        totals(ours, "our_total")
        .join(totals(statement, "statement_total"), "period_start", "full")
        .withColumn("difference", difference)
        .withColumn("within_tolerance", F.abs(F.col("difference")) <= tolerance * reference)
    )


def unmatched_references(df: DataFrame, dimension: DataFrame, key: str, dimension_key: str) -> DataFrame:
    """Reference values that the dimension does not know, with their row count."""
    values = df.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("reference")).agg(
        F.count(F.lit(1)).alias("record_count")
    )
    known = dimension.select(F.col(dimension_key).alias("reference"))
    return values.join(known, "reference", "left_anti")


def count_if(condition: Column) -> Column:
    """Rows where the condition is true; null counts as false."""
    return F.count_if(F.coalesce(condition, F.lit(False)))
