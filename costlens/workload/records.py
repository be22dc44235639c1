"""Scans, mappings, filters, joins to dimensions, sinks."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from costlens.models.baseline import by_horizon, naive
from costlens.operators.aggregate import daily_limit_flag, reconcile, unmatched_references
from costlens.operators.drift import new_values
from costlens.operators.evaluate import finite_pairs
from costlens.operators.features import align_columns
from costlens.operators.prepare import complete_series, missing_rows, positive_series
from costlens.session import scratch_path
from costlens.sources import (
    cost_records,
    filter_records,
    latest_forecast_run,
    map_attributes,
    read_csv,
    write_forecast_csv,
    write_forecast_table,
    write_records,
)
from costlens.workload.base import COST, SERIES, TOTAL, daily_by, daily_total, query, r, sig7, sig7_sql, table

RECORD_COLUMNS = [
    "subscription_id",
    "line_number",
    "usage_date",
    "meter_category",
    "resource_location",
    "quantity",
    "cost_in_billing_currency",
]
RECORD_SQL = """subscription_id, line_number, usage_date, meter_category, resource_location, quantity,
  ROUND(cost_in_billing_currency, 4) AS cost_in_billing_currency"""


def _shown(df):
    return df.withColumn("cost_in_billing_currency", r(F.col("cost_in_billing_currency")))


@query(
    "a1_load_records",
    f"""WITH {COST} SELECT {RECORD_SQL} FROM cost
WHERE usage_date BETWEEN DATE '1996-01-01' AND DATE '1996-12-31' AND meter_category = 'ECONOMY'""",
)
def a1(spark, sf):
    return _shown(filter_records(cost_records(spark, sf, RECORD_COLUMNS), "1996-01-01", "1996-12-31", "ECONOMY"))


@query("a2_csv_scan", f"WITH {SERIES} SELECT segment, ds, y FROM series")
def a2(spark, sf):
    path = scratch_path(spark, "csv")
    daily_by(spark, sf).select("segment", "ds", "y").write.option("header", True).csv(path)
    schema = T.StructType(
        [T.StructField("segment", T.StringType()), T.StructField("ds", T.DateType()), T.StructField("y", T.DoubleType())]
    )
    return read_csv(spark, path, schema)


@query(
    "a3_table_sink",
    f"""WITH {COST} SELECT strftime(usage_date, '%Y-%m') AS usage_month, COUNT(*) AS record_count,
  ROUND(SUM(cost_in_billing_currency), 4) AS total_cost FROM cost GROUP BY 1""",
)
def a3(spark, sf):
    path = scratch_path(spark, "records")
    columns = [*RECORD_COLUMNS, "effective_price", "plan_name"]
    write_records(cost_records(spark, sf, columns), path)
    return (
        spark.read.parquet(path)
        .groupBy(F.col("usage_month").cast("string").alias("usage_month"))
        .agg(F.count(F.lit(1)).alias("record_count"), F.round(F.sum("cost_in_billing_currency"), 4).alias("total_cost"))
    )


@query(
    "a9_partition_layout",
    f"""WITH {COST} SELECT {RECORD_SQL} FROM cost
WHERE usage_date BETWEEN DATE '1997-03-10' AND DATE '1997-04-20'""",
)
def a9(spark, sf):
    path = scratch_path(spark, "records")
    write_records(cost_records(spark, sf, RECORD_COLUMNS), path)
    stored = spark.read.parquet(path)
    month = F.col("usage_month").cast("string")
    pruned = stored.filter((month >= "1997-03") & (month <= "1997-04"))
    return _shown(filter_records(pruned, "1997-03-10", "1997-04-20").select(*RECORD_COLUMNS))


NAIVE_SQL = f"""last AS (SELECT segment, max(ds) AS last_ds, arg_max(y, ds) AS y FROM series GROUP BY 1),
naive AS (SELECT segment, 'naive' AS model, CAST(last_ds + CAST(s.step AS INT) AS DATE) AS ds, y AS yhat, s.step
  FROM last, (SELECT unnest(range(1, 91)) AS step) s)"""


def _naive(spark, sf, days=90):
    return naive(daily_by(spark, sf), days).withColumn("model", F.lit("naive"))


@query(
    "a4_forecast_csv_sink",
    f"""WITH {SERIES}, {NAIVE_SQL} SELECT segment, h.h AS horizon_days, ds, yhat
FROM naive, (SELECT unnest([30, 90]) AS h) h WHERE step <= h.h""",
)
def a4(spark, sf):
    path = scratch_path(spark, "forecast-csv")
    write_forecast_csv(by_horizon(_naive(spark, sf), [30, 90]).select("segment", "horizon_days", "ds", "yhat"), path)
    back = spark.read.csv(path, header=True, schema="ds date, yhat double, segment string, horizon_days int")
    return back.select("segment", "horizon_days", "ds", "yhat")


@query(
    "a5_forecast_table_sink",
    f"""WITH {SERIES}, {NAIVE_SQL}
SELECT DATE '2001-11-05' AS generated_date, model, segment, COUNT(*) AS days, ROUND(SUM(yhat), 4) AS total
FROM naive WHERE step <= 30 GROUP BY model, segment
UNION ALL SELECT DATE '2001-11-06', model, segment, COUNT(*), ROUND(SUM(yhat), 4)
FROM naive GROUP BY model, segment""",
)
def a5(spark, sf):
    path = scratch_path(spark, "forecast-table")
    write_forecast_table(_naive(spark, sf, 30), path, F.lit("2001-11-05 06:00:00"))
    write_forecast_table(_naive(spark, sf, 90), path, F.lit("2001-11-06 06:00:00"))
    return (
        spark.read.parquet(path)
        .groupBy("generated_date", "model", "segment")
        .agg(F.count(F.lit(1)).alias("days"), F.round(F.sum("yhat"), 4).alias("total"))
    )


@query(
    "a6_latest_forecast_run",
    """WITH runs AS (SELECT o_orderpriority AS segment, CAST(o_custkey % 3 AS INT) AS horizon_days,
  o_orderdate AS generated_at, o_orderkey AS forecast_id, o_totalprice AS yhat FROM orders)
SELECT segment, horizon_days, forecast_id, yhat FROM runs
QUALIFY generated_at = MAX(generated_at) OVER (PARTITION BY segment, horizon_days)""",
)
def a6(spark, sf):
    runs = table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("segment"),
        (F.col("o_custkey") % 3).cast("int").alias("horizon_days"),
        F.col("o_orderdate").alias("generated_at"),
        F.col("o_orderkey").alias("forecast_id"),
        F.col("o_totalprice").alias("yhat"),
    )
    return latest_forecast_run(runs).select("segment", "horizon_days", "forecast_id", "yhat")


@query(
    "a7_map_attributes",
    """SELECT CAST(l_shipdate AS DATE) AS usage_date, CAST(l_orderkey AS VARCHAR) AS subscription_id,
  l_quantity AS quantity, l_extendedprice AS cost_in_billing_currency, l_returnflag AS plan_name,
  l_linenumber AS line_number FROM lineitem""",
)
def a7(spark, sf):
    legacy = table(spark, sf, "lineitem").select(
        F.col("l_shipdate").alias("UsageDateTime"),
        F.col("l_orderkey").alias("SubscriptionGuid"),
        F.col("l_quantity").cast("string").alias("UsageQuantity"),
        F.col("l_extendedprice").alias("PreTaxCost"),
        F.col("l_returnflag").alias("ServiceTier"),
        F.col("l_linenumber").alias("line_number"),
    )
    return map_attributes(legacy)


@query(
    "f1_date_range",
    f"""WITH {COST} SELECT usage_date, COUNT(*) AS record_count FROM cost
WHERE usage_date >= DATE '1998-02-01' AND usage_date <= DATE '1998-02-28' GROUP BY 1""",
)
def f1(spark, sf):
    records = filter_records(cost_records(spark, sf, ["usage_date"]), "1998-02-01", "1998-02-28")
    return records.groupBy("usage_date").agg(F.count(F.lit(1)).alias("record_count"))


@query(
    "f2_category",
    f"""WITH {COST} SELECT 'PROMO' AS chosen, COUNT(*) AS record_count,
  {sig7_sql("SUM(cost_in_billing_currency)")} AS total_cost FROM cost WHERE meter_category = 'PROMO'
UNION ALL SELECT 'Total', COUNT(*), {sig7_sql("SUM(cost_in_billing_currency)")} FROM cost""",
)
def f2(spark, sf):
    records = cost_records(spark, sf, ["meter_category", "cost_in_billing_currency"])

    def total(name):
        return filter_records(records, category=name).agg(
            F.lit(name).alias("chosen"),
            F.count(F.lit(1)).alias("record_count"),
            F.sum("cost_in_billing_currency").alias("total_cost"),
        )

    return sig7(total("PROMO").unionByName(total("Total")), "total_cost")


def holed(spark, sf):
    """Cost records with missing cells: null where the quantity is 50, NaN
    where it is 1, a null region for one nation and a null date on one day."""
    cost = F.col("cost_in_billing_currency")
    quantity = F.col("quantity")
    records = cost_records(
        spark,
        sf,
        [*RECORD_COLUMNS, "effective_price", "plan_name", "billing_currency_code", "meter_sub_category"],
    )
    return records.withColumns(
        {
            "cost_in_billing_currency": F.when(quantity == 50, None).when(quantity == 1, F.lit(float("nan"))).otherwise(cost),
            "resource_location": F.when(F.col("resource_location") != "BRAZIL", F.col("resource_location")),
            "billing_currency_code": F.when(F.col("plan_name") != "A", F.col("billing_currency_code")),
        }
    )


HOLED = f"""{COST}, holed AS (
  SELECT * REPLACE (
    CASE WHEN quantity IN (1, 50) THEN NULL ELSE cost_in_billing_currency END AS cost_in_billing_currency,
    CASE WHEN resource_location <> 'BRAZIL' THEN resource_location END AS resource_location,
    CASE WHEN plan_name <> 'A' THEN billing_currency_code END AS billing_currency_code)
  FROM cost)"""


@query(
    "f3_missing_rows",
    f"""WITH {HOLED} SELECT subscription_id, line_number, usage_date, quantity, plan_name FROM holed
WHERE cost_in_billing_currency IS NULL OR resource_location IS NULL""",
)
def f3(spark, sf):
    found = missing_rows(holed(spark, sf), ["cost_in_billing_currency", "resource_location", "not_there"])
    return found.select("subscription_id", "line_number", "usage_date", "quantity", "plan_name")


BALANCES = """balances AS (SELECT c_mktsegment AS segment, DATE '2020-01-01' + CAST(c_custkey % 3650 AS INT) AS ds,
  CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE c_acctbal END AS y, c_custkey FROM customer)"""


def balances(spark, sf):
    """Customer balances as a series: negative values, nulls and NaN occur."""
    key = F.col("c_custkey")
    return table(spark, sf, "customer").select(
        F.col("c_mktsegment").alias("segment"),
        F.date_add(F.lit("2020-01-01").cast("date"), (key % 3650).cast("int")).alias("ds"),
        F.when(key % 34 == 0, None).when(key % 17 == 0, F.lit(float("nan"))).otherwise(F.col("c_acctbal")).alias("y"),
    )


@query("f4_positive_target", f"WITH {BALANCES} SELECT segment, ds, y FROM balances WHERE y > 0")
def f4(spark, sf):
    return positive_series(balances(spark, sf))


@query("f5_complete_target", f"WITH {BALANCES} SELECT segment, ds, y FROM balances WHERE y IS NOT NULL")
def f5(spark, sf):
    return complete_series(balances(spark, sf))


@query(
    "f6_finite_pairs",
    """SELECT l_orderkey, l_linenumber, l_quantity AS y, l_extendedprice AS yhat FROM lineitem
WHERE l_quantity NOT IN (1, 2, 3)""",
)
def f6(spark, sf):
    quantity = F.col("l_quantity")
    pairs = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(quantity == 1, F.lit(float("nan"))).when(quantity == 2, None).otherwise(quantity).alias("y"),
        F.when(quantity == 3, F.lit(float("-inf"))).otherwise(F.col("l_extendedprice")).alias("yhat"),
    )
    return finite_pairs(pairs)


@query(
    "f8_align_columns",
    """SELECT l_orderkey, l_quantity, 0 AS not_there, l_tax FROM lineitem""",
)
def f8(spark, sf):
    return align_columns(table(spark, sf, "lineitem"), ["l_orderkey", "l_quantity", "not_there", "l_tax"])


@query(
    "f10_domain_rule",
    f"WITH {TOTAL} SELECT segment, ds, y, y > 600000.0 AS over_limit FROM series",
)
def f10(spark, sf):
    return daily_limit_flag(daily_total(spark, sf).select("segment", "ds", "y"), 600000.0, "y")


@query(
    "j6_new_values",
    """WITH base AS (SELECT DISTINCT p_brand || p_type AS value FROM lineitem JOIN part ON l_partkey = p_partkey
  WHERE CAST(l_shipdate AS DATE) < DATE '1995-02-01'),
now AS (SELECT p_brand || p_type AS value, COUNT(*) AS record_count FROM lineitem JOIN part ON l_partkey = p_partkey
  WHERE CAST(l_shipdate AS DATE) >= DATE '1995-02-01' GROUP BY 1)
SELECT value, record_count FROM now WHERE value NOT IN (SELECT value FROM base)""",
)
def j6(spark, sf):
    records = cost_records(spark, sf, ["usage_date", "meter_category", "meter_sub_category"]).withColumn(
        "meter", F.concat("meter_sub_category", "meter_category")
    )
    return new_values(
        filter_records(records, end_date="1995-01-31"), filter_records(records, start_date="1995-02-01"), "meter"
    )


@query(
    "j7_unmatched_references",
    """SELECT l_orderkey AS reference, COUNT(*) AS record_count FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') GROUP BY 1""",
)
def j7(spark, sf):
    known = table(spark, sf, "orders").filter(F.col("o_orderstatus") != "P")
    return unmatched_references(table(spark, sf, "lineitem").select("l_orderkey"), known, "l_orderkey", "o_orderkey")


@query(
    "j8_reconcile",
    f"""WITH ours AS (SELECT date_trunc('month', CAST(l_shipdate AS DATE))::DATE AS period_start,
    SUM(l_extendedprice * (1 - l_discount)) AS our_total FROM lineitem GROUP BY 1),
theirs AS (SELECT date_trunc('month', CAST(o_orderdate AS DATE))::DATE AS period_start,
    SUM(o_totalprice) AS statement_total FROM orders GROUP BY 1)
SELECT period_start, {sig7_sql("our_total")} AS our_total, {sig7_sql("statement_total")} AS statement_total,
  {sig7_sql("COALESCE(our_total, 0) - COALESCE(statement_total, 0)")} AS difference,
  ABS(COALESCE(our_total, 0) - COALESCE(statement_total, 0)) <= 0.5 * ABS(COALESCE(statement_total, 0)) AS within_tolerance
FROM ours FULL JOIN theirs USING (period_start)""",
)
def j8(spark, sf):
    ours = cost_records(spark, sf, ["usage_date", "cost_in_billing_currency"])
    statement = table(spark, sf, "orders").select(
        F.to_date("o_orderdate").alias("usage_date"), F.col("o_totalprice").alias("cost_in_billing_currency")
    )
    out = reconcile(ours, statement, "month", 0.5)
    return sig7(out, "our_total", "statement_total", "difference")
