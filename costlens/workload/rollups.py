"""Daily series, segment levels, distributions, profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from costlens.operators import aggregate as agg
from costlens.operators.duplicates import count_distinct_rows
from costlens.operators.drift import describe_baseline
from costlens.operators.order_stats import exact_quantiles
from costlens.operators.prepare import difference
from costlens.operators.residuals import residual_moments
from costlens.sources import cost_records
from costlens.workload.base import (
    AS_OF,
    COST,
    DAYS,
    SERIES,
    SERIES_COLUMNS,
    daily_by,
    query,
    rounded,
    sig7,
    sig7_sql,
    table,
)

COST_COL = "cost_in_billing_currency"


@query(
    "g1_daily_cost",
    f"""WITH {COST} SELECT usage_date, meter_category, ROUND(SUM({COST_COL}), 4) AS daily_cost,
  SUM(quantity) AS total_quantity, {sig7_sql("AVG(effective_price)")} AS avg_rate FROM cost GROUP BY 1, 2""",
)
def g1(spark, sf):
    out = agg.daily_costs(cost_records(spark, sf, [*SERIES_COLUMNS, "meter_category"]), ["meter_category"])
    return sig7(rounded(out, 4, "daily_cost"), "avg_rate")


@query(
    "g1_daily_total",
    f"""WITH {COST} SELECT usage_date, ROUND(SUM({COST_COL}), 4) AS daily_cost,
  SUM(quantity) AS total_quantity, {sig7_sql("AVG(effective_price)")} AS avg_rate FROM cost GROUP BY 1""",
)
def g1_total(spark, sf):
    out = agg.daily_costs(cost_records(spark, sf, SERIES_COLUMNS))
    return sig7(rounded(out, 4, "daily_cost"), "avg_rate")


@query(
    "g2_segment_levels",
    f"""WITH {COST}, levels AS (SELECT GROUPING(meter_category) AS gc, GROUPING(resource_location) AS gr,
  usage_date, meter_category AS c, resource_location AS l, SUM({COST_COL}) AS daily_cost,
  SUM(quantity) AS total_quantity, AVG(effective_price) AS avg_rate FROM cost
  GROUP BY GROUPING SETS ((usage_date), (usage_date, meter_category), (usage_date, resource_location),
    (usage_date, meter_category, resource_location)))
SELECT CASE WHEN gc = 1 AND gr = 1 THEN 'total' WHEN gr = 1 THEN 'category' WHEN gc = 1 THEN 'region'
    ELSE 'category_region' END AS segment_level,
  CASE WHEN gc = 1 AND gr = 1 THEN 'Total' WHEN gr = 1 THEN c WHEN gc = 1 THEN l ELSE c || '|' || l END AS segment,
  usage_date, ROUND(daily_cost, 4) AS daily_cost, total_quantity, {sig7_sql("avg_rate")} AS avg_rate FROM levels""",
)
def g2(spark, sf):
    records = cost_records(spark, sf, [*SERIES_COLUMNS, "meter_category", "resource_location"])
    return sig7(rounded(agg.segment_daily_costs(records), 4, "daily_cost"), "avg_rate")


def _distribution_sql(key):
    return f"""WITH {COST} SELECT {key}, COUNT(*) AS record_count, {sig7_sql(f"SUM({COST_COL})")} AS total_cost,
  ROUND(SUM({COST_COL}) / SUM(SUM({COST_COL})) OVER (), 8) AS cost_share FROM cost GROUP BY 1"""


@query("g3_region_distribution", _distribution_sql("resource_location"))
def g3(spark, sf):
    out = agg.distribution(cost_records(spark, sf, ["resource_location", COST_COL]), "resource_location")
    return sig7(rounded(out, 8, "cost_share"), "total_cost")


@query("g4_category_distribution", _distribution_sql("meter_category"))
def g4(spark, sf):
    out = agg.distribution(cost_records(spark, sf, ["meter_category", COST_COL]), "meter_category")
    return sig7(rounded(out, 8, "cost_share"), "total_cost")


@query(
    "g5_data_profile",
    f"WITH {COST} SELECT COUNT(*) AS total_records, MIN(usage_date) AS min_date, MAX(usage_date) AS max_date FROM cost",
)
def g5(spark, sf):
    return agg.data_profile(cost_records(spark, sf, ["usage_date"]))


@query(
    "g6_data_availability",
    f"""WITH {COST} SELECT COUNT(*) AS record_count, MAX(usage_date) AS latest_date,
  (epoch(TIMESTAMP '{AS_OF}') - epoch(MAX(usage_date)::TIMESTAMP)) / 3600.0 AS hours_old,
  (epoch(TIMESTAMP '{AS_OF}') - epoch(MAX(usage_date)::TIMESTAMP)) / 3600.0 <= 168 AS is_fresh,
  COUNT(*) > 0 AS is_available FROM cost""",
)
def g6(spark, sf):
    return agg.data_availability(cost_records(spark, sf, ["usage_date"]), AS_OF)


def _period_sql(period):
    return f"""WITH {SERIES} SELECT segment, date_trunc('{period}', ds)::DATE AS period_start,
  ROUND(SUM(y), 4) AS period_total, COUNT(y) AS days FROM series GROUP BY 1, 2"""


@query("g7_weekly_rollup", _period_sql("week"))
def g7_week(spark, sf):
    return rounded(agg.roll_up(daily_by(spark, sf), "week"))


@query("g7_monthly_rollup", _period_sql("month"))
def g7_month(spark, sf):
    return rounded(agg.roll_up(daily_by(spark, sf), "month"))


@query(
    "g8_minimum_history",
    f"""WITH {SERIES} SELECT segment, MIN(ds) AS first_day, MAX(ds) AS last_day,
  ROUND((MAX(ds) - MIN(ds)) / 30.0::DOUBLE, 6) AS months_available, (MAX(ds) - MIN(ds)) / 30.0 >= 83 AS has_minimum
FROM series GROUP BY 1""",
)
def g8(spark, sf):
    return rounded(agg.minimum_history(daily_by(spark, sf), 83), 6)


@query(
    "g9_region_share",
    f"""WITH {COST}, t AS (SELECT resource_location, SUM({COST_COL}) AS c, SUM(SUM({COST_COL})) OVER () AS total
  FROM cost GROUP BY 1), w(region, expected_share) AS (VALUES ('CHINA', 0.9::DOUBLE), ('BRAZIL', 0.1::DOUBLE),
  ('ATLANTIS', 0.0::DOUBLE))
SELECT region, expected_share, ROUND(COALESCE(c / total, 0), 8) AS actual_share,
  ROUND(ABS(COALESCE(c / total, 0) - expected_share), 8) AS deviation
FROM w LEFT JOIN t ON region = resource_location""",
)
def g9(spark, sf):
    records = cost_records(spark, sf, ["resource_location", COST_COL])
    return rounded(agg.region_share_deviation(records, {"CHINA": 0.9, "BRAZIL": 0.1, "ATLANTIS": 0.0}), 8)


@query(
    "g10_record_count_check",
    f"""WITH {COST}, d AS (SELECT usage_date, COUNT(*) AS record_count FROM cost GROUP BY 1),
e AS (SELECT *, CASE WHEN COUNT(*) OVER w = 7 THEN AVG(record_count) OVER w END AS expected_count FROM d
  WINDOW w AS (ORDER BY usage_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
SELECT usage_date, record_count, ROUND(expected_count, 6) AS expected_count,
  COALESCE(ABS(record_count - expected_count) > 0.3 * expected_count, FALSE) AS is_unexpected FROM e""",
)
def g10(spark, sf):
    return rounded(agg.record_count_check(cost_records(spark, sf, ["usage_date"]), 0.3), 6)


@query(
    "g11_distinct_records",
    """SELECT COUNT(*) AS distinct_records FROM (SELECT DISTINCT * FROM (
SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_linenumber = 1))""",
)
def g11(spark, sf):
    lines = table(spark, sf, "lineitem")
    rows = lines.unionByName(lines.filter("l_linenumber = 1"))
    return count_distinct_rows(rows).select("distinct_records")


@query(
    "g12_baseline_moments",
    """SELECT 'l_quantity' AS feature, COUNT(*) AS n, ROUND(AVG(l_quantity), 6) AS mean,
  ROUND(STDDEV_SAMP(l_quantity), 6) AS std FROM lineitem
UNION ALL SELECT 'l_extendedprice', COUNT(*), ROUND(AVG(l_extendedprice), 6), ROUND(STDDEV_SAMP(l_extendedprice), 6)
FROM lineitem""",
)
def g12(spark, sf):
    return rounded(describe_baseline(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice"]), 6)


@query(
    "g13_exact_percentiles",
    f"""WITH {COST} SELECT meter_category, {sig7_sql(f"quantile_cont({COST_COL}, 0.25)")} AS p25,
  {sig7_sql(f"quantile_cont({COST_COL}, 0.5)")} AS p50, {sig7_sql(f"quantile_cont({COST_COL}, 0.99)")} AS p99
FROM cost GROUP BY 1""",
)
def g13(spark, sf):
    records = cost_records(spark, sf, ["meter_category", COST_COL])
    q = exact_quantiles(records, COST_COL, [0.25, 0.5, 0.99], ["meter_category"], narrow=True)
    names = ("p25", "p50", "p99")
    return sig7(q.select("meter_category", *[F.col("quantiles")[i].alias(n) for i, n in enumerate(names)]), *names)


@query(
    "g15_residual_moments",
    f"""WITH {SERIES}, res AS (SELECT segment, y - LAG(y, 7) OVER ({DAYS}) AS residual FROM series)
SELECT segment, ROUND(AVG(residual), 4) AS residual_mean, ROUND(STDDEV_SAMP(residual), 3) AS residual_std
FROM res GROUP BY 1""",
)
def g15(spark, sf):
    residuals = difference(daily_by(spark, sf), order=0, seasonal_lag=7, out_col="residual")
    return rounded(rounded(residual_moments(residuals), 4, "residual_mean"), 3, "residual_std")


@query(
    "k5_top_drivers",
    f"""WITH {COST}, d AS (SELECT meter_category, resource_id, SUM({COST_COL}) AS total_cost FROM cost GROUP BY 1, 2)
SELECT meter_category, resource_id, {sig7_sql("total_cost")} AS total_cost,
  ROW_NUMBER() OVER (PARTITION BY meter_category ORDER BY total_cost DESC, resource_id)::INT AS position
FROM d QUALIFY position <= 5""",
)
def k5(spark, sf):
    records = cost_records(spark, sf, ["meter_category", "resource_id", COST_COL])
    return sig7(agg.top_drivers(records, "resource_id", 5), "total_cost")


@query(
    "s9_cost_by_tag",
    """WITH t AS (SELECT unnest(json_keys(props)) AS tag_key, props, value FROM events)
SELECT tag_key, json_extract_string(props, '$.' || tag_key) AS tag_value, COUNT(*) AS record_count,
  ROUND(SUM(value), 4) AS total_cost FROM t GROUP BY 1, 2""",
)
def s9(spark, sf):
    return rounded(agg.cost_by_tag(table(spark, sf, "events"), "props", "value"))
