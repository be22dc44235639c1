"""Data-quality checks on records with missing cells, credits and copies."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from costlens.operators import quality as q
from costlens.sources import cost_records
from costlens.sources.records import RAW_SCHEMA
from costlens.workload.base import AS_OF, COST, query, rounded, table
from costlens.workload.records import HOLED, holed

_KEYS = ("usage_date", "cost_in_billing_currency", "meter_category", "resource_location", "billing_currency_code")
_MISSING = " + ".join(f"COUNT_IF({k} IS NULL)" for k in _KEYS)


@query(
    "q1_completeness",
    f"""WITH {HOLED}, c AS (SELECT COUNT(*) AS n, ({_MISSING})::BIGINT AS m FROM holed)
SELECT n AS total_records, m AS missing_cells, ROUND((n - m) * 100.0 / n::DOUBLE, 6) AS completeness_rate,
  ROUND((5 * n - m) * 100.0 / (5 * n)::DOUBLE, 6) AS cell_completeness_rate,
  (n - m) * 100.0 / n::DOUBLE >= 95 AS meets_threshold FROM c""",
)
def q1(spark, sf):
    return rounded(q.completeness(holed(spark, sf)), 6)


_MISSING_ROWS = " UNION ALL ".join(
    f"""SELECT '{k}' AS "column", COUNT_IF({k} IS NULL)::BIGINT AS missing_count,
  COUNT_IF({k} IS NULL) * 100.0 / COUNT(*)::DOUBLE AS p FROM holed"""
    for k in _KEYS
)


@query(
    "q1_missing_by_column",
    f"""WITH {HOLED}, m AS ({_MISSING_ROWS}) SELECT "column", missing_count, ROUND(p, 6) AS missing_pct,
  CASE WHEN p > 10 THEN 'CRITICAL' WHEN p > 5 THEN 'WARNING' ELSE 'OK' END AS alert_level FROM m""",
)
def q1_long(spark, sf):
    return rounded(q.missing_by_column(holed(spark, sf)), 6)


@query(
    "q7_missing_alerts",
    f"""WITH {HOLED}, m AS ({_MISSING_ROWS}) SELECT "column",
  CASE WHEN p > 10 THEN 'CRITICAL' WHEN p > 5 THEN 'WARNING' ELSE 'OK' END AS alert_level FROM m WHERE p > 5""",
)
def q7(spark, sf):
    found = q.missing_by_column(holed(spark, sf)).select("column", "alert_level")
    return found.filter(F.col("alert_level") != "OK")


def _credits(spark, sf):
    """Records where some costs are credits (negative) and some are free."""
    cost, quantity = F.col("cost_in_billing_currency"), F.col("quantity")
    records = cost_records(spark, sf, ["usage_date", "cost_in_billing_currency", "quantity", "billing_currency_code", "plan_name"])
    return records.withColumns(
        {
            "cost_in_billing_currency": F.when(quantity == 7, -cost).when(quantity == 8, F.lit(0.0)).otherwise(cost),
            "billing_currency_code": F.when(F.col("plan_name") != "A", F.col("billing_currency_code")),
        }
    )


CREDITS = f"""{COST}, credits AS (SELECT * REPLACE (
  CASE WHEN quantity = 7 THEN -cost_in_billing_currency WHEN quantity = 8 THEN 0.0
    ELSE cost_in_billing_currency END AS cost_in_billing_currency,
  CASE WHEN plan_name <> 'A' THEN billing_currency_code END AS billing_currency_code) FROM cost)"""


@query(
    "q2_accuracy",
    f"""WITH {CREDITS} SELECT COUNT_IF(cost_in_billing_currency < 0)::BIGINT AS negative_costs,
  COUNT_IF(cost_in_billing_currency = 0)::BIGINT AS zero_costs,
  COUNT_IF(billing_currency_code <> 'USD')::BIGINT AS foreign_currency,
  MIN(usage_date) AS min_date, MAX(usage_date) AS max_date,
  COUNT_IF(cost_in_billing_currency < 0) > 0 OR COUNT_IF(billing_currency_code <> 'USD') > 0 AS has_issues
FROM credits""",
)
def q2(spark, sf):
    return q.accuracy(_credits(spark, sf))


@query(
    "q3_consistency",
    """WITH r AS (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_linenumber = 1),
c AS (SELECT (SELECT COUNT(*) FROM r) AS n, COUNT(*) AS k FROM (SELECT DISTINCT * FROM r))
SELECT n AS total_records, k AS distinct_records, n - k AS duplicate_count, ROUND((n - k) * 100.0 / n::DOUBLE, 6) AS duplicate_pct FROM c""",
)
def q3(spark, sf):
    """Whole rows; every order's first line stands there twice."""
    lines = table(spark, sf, "lineitem")
    return rounded(q.consistency(lines.unionByName(lines.filter("l_linenumber = 1"))), 6)


@query(
    "q3_short_rows",
    """WITH c AS (SELECT COUNT(*) AS k FROM lineitem GROUP BY l_returnflag, l_linestatus, l_quantity, l_shipdate)
SELECT SUM(k)::BIGINT AS total_records, COUNT(*) AS distinct_records, (SUM(k) - COUNT(*))::BIGINT AS duplicate_count,
  ROUND((SUM(k) - COUNT(*)) * 100.0 / SUM(k)::DOUBLE, 6) AS duplicate_pct FROM c""",
)
def q3_short(spark, sf):
    """A table of four columns, most of whose rows repeat."""
    rows = table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity", "l_shipdate")
    return rounded(q.consistency(rows), 6)


_AGE = f"(epoch(TIMESTAMP '{AS_OF}') - epoch(MAX(usage_date)::TIMESTAMP)) / 3600.0"


@query(
    "q4_timeliness",
    f"WITH {COST} SELECT MAX(usage_date) AS latest_date, {_AGE} AS hours_old, {_AGE} <= 48 AS meets_sla FROM cost",
)
def q4(spark, sf):
    return q.timeliness(cost_records(spark, sf, ["usage_date"]), AS_OF, 48.0)


_REPORT = f"""WITH {HOLED}, rows AS (SELECT * FROM holed UNION ALL SELECT * FROM holed WHERE line_number = 1),
d AS (SELECT COUNT(*) AS distinct_records FROM (SELECT DISTINCT * REPLACE (
    CASE WHEN quantity = 1 THEN 'NaN'::DOUBLE ELSE cost_in_billing_currency END AS cost_in_billing_currency) FROM rows)),
c AS (SELECT COUNT(*) AS total_records, ({_MISSING})::BIGINT AS missing_cells,
    COUNT_IF(cost_in_billing_currency < 0)::BIGINT AS negative_costs,
    COUNT_IF(cost_in_billing_currency = 0)::BIGINT AS zero_costs,
    COUNT_IF(billing_currency_code <> 'USD')::BIGINT AS foreign_currency,
    MIN(usage_date) AS min_date, MAX(usage_date) AS max_date, {_AGE} AS hours_old FROM rows),
q AS (SELECT *, (total_records - missing_cells) * 100.0 / total_records::DOUBLE AS completeness_rate,
    (5 * total_records - missing_cells) * 100.0 / (5 * total_records)::DOUBLE AS cell_completeness_rate,
    negative_costs > 0 OR foreign_currency > 0 AS has_issues, hours_old <= 168 AS meets_sla,
    total_records - distinct_records AS duplicate_count,
    (total_records - distinct_records) * 100.0 / total_records::DOUBLE AS duplicate_pct FROM c, d),
s AS (SELECT *, 0.3 * completeness_rate + 0.3 * CASE WHEN has_issues THEN 80.0 ELSE 100.0 END
    + 0.2 * (100.0 - LEAST(duplicate_pct, 10.0)) + 0.2 * CASE WHEN meets_sla THEN 100.0 ELSE 70.0 END AS quality_score
  FROM q)"""


def _report(spark, sf):
    """Whole rows; every order's first line stands there twice."""
    rows = holed(spark, sf)
    return q.quality_report(rows.unionByName(rows.filter("line_number = 1")), AS_OF)


@query(
    "q5_quality_report",
    f"""{_REPORT} SELECT total_records, missing_cells, ROUND(completeness_rate, 6) AS completeness_rate,
  ROUND(cell_completeness_rate, 6) AS cell_completeness_rate, completeness_rate >= 95 AS meets_threshold,
  negative_costs, zero_costs, foreign_currency, min_date, max_date, has_issues, hours_old, meets_sla,
  distinct_records, duplicate_count, ROUND(duplicate_pct, 6) AS duplicate_pct,
  ROUND(quality_score, 6) AS quality_score, quality_score < 80 AS below_gate FROM s""",
)
def q5(spark, sf):
    return rounded(_report(spark, sf), 6, "completeness_rate", "cell_completeness_rate", "duplicate_pct", "quality_score")


@query(
    "q6_quality_score",
    f"{_REPORT} SELECT ROUND(quality_score, 6) AS quality_score, quality_score < 80 AS below_gate FROM s",
)
def q6(spark, sf):
    return rounded(_report(spark, sf).select("quality_score", "below_gate"), 6)


@query("q8_schema_check")
def q8(spark, sf):
    """Declared types against the types of the mapped records (no rows read)
    joined to the count of values that a string feed could not cast."""
    records = cost_records(spark, sf)
    feed = records.select(*[F.col(c).cast("string").alias(c) for c in ("usage_date", "quantity")])
    declared = T.StructType(
        [
            T.StructField("usage_date", T.DateType()),
            T.StructField("quantity", T.IntegerType()),
        ]
    )
    return q.schema_check(records, RAW_SCHEMA).join(q.cast_failures(feed, declared), "column", "left")


@query(
    "q8_cast_failures",
    """SELECT 'quantity' AS "column", COUNT_IF(TRY_CAST(CAST(l_quantity / 2 AS VARCHAR) AS DATE) IS NULL)::BIGINT AS failures
FROM lineitem UNION ALL
SELECT 'plan_name', COUNT_IF(TRY_CAST(l_returnflag AS DOUBLE) IS NULL)::BIGINT FROM lineitem UNION ALL
SELECT 'usage_date', 0::BIGINT""",
)
def q8_feed(spark, sf):
    feed = cost_records(spark, sf, ["usage_date", "quantity", "plan_name"])
    text = feed.select(*[F.col(c).cast("string").alias(c) for c in feed.columns])
    declared = T.StructType(
        [
            T.StructField("usage_date", T.DateType()),
            T.StructField("quantity", T.DateType()),
            T.StructField("plan_name", T.DoubleType()),
        ]
    )
    return q.cast_failures(text, declared)
