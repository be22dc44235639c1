"""Hot keys, bounded broadcasts, and plans that must not move raw rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from costlens.operators import aggregate as agg
from costlens.operators import quality as q
from costlens.operators.attach import attach
from costlens.operators.order_stats import cumulative_counts, exact_quantiles
from costlens.operators.prepare import flag_outliers
from costlens.sources import cost_records, latest_forecast_run


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows are copies of one row; one segment holds half."""
    i = F.col("id")
    hot = i % 3 == 0
    return spark.range(60_000).select(
        F.when(hot, F.lit("hot")).otherwise(F.concat(F.lit("s"), (i % 7).cast("string"))).alias("segment"),
        F.when(hot, F.lit(5.0)).otherwise((i % 1000).cast("double")).alias("y"),
        F.when(hot, F.lit(0)).otherwise(i).alias("k"),
    )


@pytest.mark.parametrize("limit,join", [(100, "BroadcastHashJoin"), (3, "SortMergeJoin")])
def test_statistics_are_broadcast_up_to_a_row_limit(spark, skewed, limit, join):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stats = skewed.groupBy("segment").agg(F.avg("y").alias("mean"))
        joined = attach(skewed, stats, ["segment"], limit)
        assert join in plan_of(joined)
        assert joined.filter("mean is not null").count() == 60_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_raw_rows_stay_where_they_are_when_flagged(skewed):
    plan = plan_of(flag_outliers(skewed, "y", "p99", ["segment"], raw=True))
    assert "hashpartitioning(segment" not in plan


def test_copies_are_combined_before_the_shuffle(skewed):
    row = q.consistency(skewed).first()
    assert row["duplicate_count"] == 19_999 and row["total_records"] == 60_000
    plan = plan_of(q.consistency(skewed))
    assert plan.index("partial_count") > plan.index("Exchange")


def test_narrowing_shuffles_few_values(spark, skewed):
    from costlens.operators.order_stats import _compress

    wide = spark.range(400_000).select(F.rand(3).alias("y"))
    compressed = _compress(wide, "y", [0.5, 0.99], [])
    assert compressed.count() < 1000 and compressed.agg(F.sum("n")).first()[0] == 400_000
    assert cumulative_counts(skewed, "y").count() == skewed.select("y").distinct().count()


def test_quantiles_of_a_hot_segment(skewed):
    got = {r["segment"]: r["quantiles"] for r in exact_quantiles(skewed, "y", [0.5, 0.9], ["segment"], narrow=True).collect()}
    assert got["hot"] == [5.0, 5.0] and len(got) == 8


def test_daily_series_reads_no_dimension_and_shuffles_once(spark, sf):
    daily = agg.daily_costs(cost_records(spark, sf, ["usage_date", "cost_in_billing_currency", "quantity", "effective_price"]))
    plan = plan_of(daily)
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1


def test_segment_levels_expand_after_the_first_aggregate(spark, sf):
    columns = ["usage_date", "cost_in_billing_currency", "quantity", "effective_price", "meter_category", "resource_location"]
    plan = plan_of(agg.segment_daily_costs(cost_records(spark, sf, columns)))
    # The text lists parents first: the expansion lies above an exchange.
    assert plan.count("Expand") == 1 and "Exchange" in plan[plan.index("Expand") :]


def test_shares_aggregate_once(spark, sf):
    shares = agg.distribution(cost_records(spark, sf, ["resource_location", "cost_in_billing_currency"]), "resource_location")
    shares.collect()
    assert "ReusedExchange" in plan_of(shares)


def test_top_drivers_cut_groups_before_the_shuffle(spark, sf):
    records = cost_records(spark, sf, ["meter_category", "resource_id", "cost_in_billing_currency"])
    assert "WindowGroupLimit" in plan_of(agg.top_drivers(records, "resource_id", 3))


def test_latest_run_sorts_no_group(skewed):
    runs = skewed.withColumns({"horizon_days": F.lit(30), "generated_at": F.col("k")})
    plan = plan_of(latest_forecast_run(runs))
    assert "Window" not in plan and "LeftSemi" in plan
