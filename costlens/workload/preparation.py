"""Missing values, outliers, gaps, splits, model input frames."""

from __future__ import annotations

from pyspark.sql import functions as F

from costlens.operators import prepare as p
from costlens.sources import cost_records
from costlens.workload.base import (
    COST,
    DAYS,
    ORDERS,
    SERIES,
    TOTAL,
    daily_by,
    daily_total,
    order_series,
    query,
    rounded,
    sig7,
    sig7_sql,
    table,
)
from costlens.workload.records import BALANCES, HOLED, balances, holed

COST_COL = "cost_in_billing_currency"


@query(
    "p1_fill_missing",
    f"""WITH {HOLED} SELECT subscription_id, line_number, COALESCE(resource_location, 'Unknown') AS resource_location,
  ROUND(COALESCE({COST_COL}, 0.0), 4) AS {COST_COL}, plan_name FROM holed""",
)
def p1(spark, sf):
    filled = p.fill_missing(holed(spark, sf)).select(
        "subscription_id", "line_number", "resource_location", COST_COL, "plan_name"
    )
    return rounded(filled)


SPARSE = """sparse AS (SELECT o_orderpriority AS segment, CAST(o_orderdate AS DATE) AS ds,
  ROUND(SUM(CASE WHEN o_custkey % 5 > 0 THEN o_totalprice END), 2) AS y FROM orders GROUP BY 1, 2)"""


def sparse_series(spark, sf):
    """Order value by priority with null days and missing days."""
    value = F.when(F.col("o_custkey") % 5 > 0, F.col("o_totalprice"))
    return (
        table(spark, sf, "orders")
        .groupBy(F.col("o_orderpriority").alias("segment"), F.to_date("o_orderdate").alias("ds"))
        .agg(F.round(F.sum(value), 2).alias("y"))
    )


@query(
    "p2_fill_median",
    f"""WITH {SPARSE} SELECT segment, ds, ROUND(COALESCE(y, MEDIAN(y) OVER (PARTITION BY segment)), 3) AS y FROM sparse""",
)
def p2(spark, sf):
    return rounded(p.fill_median(sparse_series(spark, sf)), 3)


@query(
    "p3_fill_tags",
    "SELECT event_id, COALESCE(CASE WHEN event_type <> 'view' THEN props END, '{}') AS tags FROM events",
)
def p3(spark, sf):
    events = table(spark, sf, "events").select(
        "event_id", F.when(F.col("event_type") != "view", F.col("props")).alias("tags")
    )
    return p.fill_missing(events)


SPINE = """spine AS (SELECT segment, unnest(generate_series(MIN(ds)::TIMESTAMP, MAX(ds)::TIMESTAMP, INTERVAL 1 DAY))::DATE AS ds
  FROM {0} GROUP BY segment)"""


@query(
    "j5_densify",
    f"""WITH {ORDERS}, {SPINE.format('series')} SELECT s.segment, s.ds, COALESCE(y, 0.0) AS y, y IS NULL AS is_filled
FROM spine s LEFT JOIN series t ON s.segment = t.segment AND s.ds = t.ds""",
)
def j5(spark, sf):
    return p.densify(order_series(spark, sf))


_GAPS = f"""{SPARSE}, {SPINE.format('sparse')}, gaps AS (SELECT s.segment, s.ds, y FROM spine s
  LEFT JOIN sparse t ON s.segment = t.segment AND s.ds = t.ds)"""


@query(
    "p4_forward_fill",
    f"WITH {_GAPS} SELECT segment, ds, LAST_VALUE(y IGNORE NULLS) OVER ({DAYS}) AS y FROM gaps",
)
def p4(spark, sf):
    return p.forward_fill(p.densify(sparse_series(spark, sf), fill=None)).select("segment", "ds", "y")


@query(
    "p5_interpolate",
    f"""WITH {_GAPS}, n AS (SELECT *, LAST_VALUE(y IGNORE NULLS) OVER b AS y0,
    LAST_VALUE(CASE WHEN y IS NOT NULL THEN ds END IGNORE NULLS) OVER b AS d0,
    FIRST_VALUE(y IGNORE NULLS) OVER a AS y1, FIRST_VALUE(CASE WHEN y IS NOT NULL THEN ds END IGNORE NULLS) OVER a AS d1
  FROM gaps WINDOW b AS ({DAYS} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    a AS ({DAYS} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT segment, ds, {sig7_sql('COALESCE(y, y0 + (y1 - y0) * ((ds - d0)::DOUBLE / (d1 - d0)::DOUBLE))')} AS y FROM n""",
)
def p5(spark, sf):
    return sig7(p.interpolate(p.densify(sparse_series(spark, sf), fill=None)).select("segment", "ds", "y"), "y")


@query(
    "p6_p99_outliers",
    f"""WITH {COST}, b AS (SELECT meter_category, quantile_cont({COST_COL}, 0.99) AS p99 FROM cost GROUP BY 1)
SELECT subscription_id, line_number, c.meter_category, {COST_COL} > p99 AS is_outlier
FROM cost c JOIN b ON c.meter_category = b.meter_category""",
)
def p6(spark, sf):
    records = cost_records(spark, sf, ["subscription_id", "line_number", "meter_category", COST_COL])
    return p.flag_outliers(records, COST_COL, "p99", ["meter_category"], raw=True).drop(COST_COL)


@query(
    "p7_iqr_outliers",
    f"""WITH {SERIES}, b AS (SELECT segment, quantile_cont(y, 0.25) AS q1, quantile_cont(y, 0.75) AS q3 FROM series GROUP BY 1)
SELECT s.segment, ds, y, y < q1 - 1.5 * (q3 - q1) OR y > q3 + 1.5 * (q3 - q1) AS is_outlier
FROM series s JOIN b ON s.segment = b.segment""",
)
def p7(spark, sf):
    return p.flag_outliers(daily_by(spark, sf).select("segment", "ds", "y"), "y", "iqr")


@query(
    "p8_zscore_outliers",
    f"""WITH {SERIES}, b AS (SELECT segment, AVG(y) AS m, STDDEV_SAMP(y) AS s FROM series GROUP BY 1)
SELECT t.segment, ds, y, COALESCE(s > 0 AND ABS(y - m) > 3 * s, FALSE) AS is_outlier
FROM series t JOIN b ON t.segment = b.segment""",
)
def p8(spark, sf):
    return p.flag_outliers(daily_by(spark, sf).select("segment", "ds", "y"), "y", "zscore")


_P99 = "b AS (SELECT segment, quantile_cont(y, 0.99) AS p99 FROM series GROUP BY 1)"


@query(
    "p9_cap_outliers",
    f"""WITH {SERIES}, {_P99} SELECT s.segment, ds, {sig7_sql("LEAST(y, p99)")} AS y
FROM series s JOIN b ON s.segment = b.segment""",
)
def p9_cap(spark, sf):
    return sig7(p.treat_outliers(daily_by(spark, sf).select("segment", "ds", "y"), "y", "cap"), "y")


@query(
    "p9_remove_outliers",
    f"WITH {SERIES}, {_P99} SELECT s.segment, ds, y FROM series s JOIN b ON s.segment = b.segment WHERE y <= p99",
)
def p9_remove(spark, sf):
    return p.treat_outliers(daily_by(spark, sf).select("segment", "ds", "y"), "y", "remove")


def _labelled(train_end, validation_end):
    return f"""n AS (SELECT segment, ds, y, ROW_NUMBER() OVER ({DAYS}) AS i, COUNT(*) OVER (PARTITION BY segment) AS n
  FROM series), cut AS (SELECT *, {train_end} AS a, {validation_end} AS b FROM n), labelled AS (SELECT segment, ds, y,
  CASE WHEN i <= a THEN 'train' WHEN i <= b THEN 'validation' ELSE 'test' END AS split FROM cut)"""


LABELLED = _labelled("floor(n * 0.7::DOUBLE)", "floor(n * 0.7::DOUBLE) + floor(n * 0.15::DOUBLE)")
BOOSTED = _labelled("floor(n * (1::DOUBLE - 0.2::DOUBLE - 0.1::DOUBLE))", "floor(n * (1::DOUBLE - 0.2::DOUBLE))")


@query("p10_split", f"WITH {SERIES}, {LABELLED} SELECT segment, ds, y, split FROM labelled")
def p10(spark, sf):
    return p.split_by_fraction(daily_by(spark, sf).select("segment", "ds", "y"))


@query(
    "p10_split_records",
    """WITH k AS (SELECT *, CAST(l_shipdate AS DATE) AS d, md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey)) AS h
  FROM lineitem), n AS (SELECT *, ROW_NUMBER() OVER (ORDER BY d, h) AS i, COUNT(*) OVER () AS n FROM k),
cut AS (SELECT *, floor(n * 0.7::DOUBLE) AS a, floor(n * 0.7::DOUBLE) + floor(n * 0.15::DOUBLE) AS b FROM n),
g AS (SELECT *, MIN(i) OVER (PARTITION BY d, h) AS first_i FROM cut)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN first_i <= a THEN 'train' WHEN first_i <= b THEN 'validation' ELSE 'test' END AS split FROM g""",
)
def p10_records(spark, sf):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    rows = table(spark, sf, "lineitem").select(*keys, "l_shipdate")
    return p.split_records(rows, date_col="l_shipdate", tie_cols=keys).drop("l_shipdate")


@query("p11_split_boosted", f"WITH {SERIES}, {BOOSTED} SELECT segment, ds, y, split FROM labelled")
def p11(spark, sf):
    return p.split_boosted(daily_by(spark, sf).select("segment", "ds", "y"))


@query(
    "p12_split_months",
    f"""WITH {SERIES}, m AS (SELECT segment, ds, y, MAX(ds) OVER (PARTITION BY segment) AS last FROM series)
SELECT segment, ds, y, CASE WHEN ds > (last - INTERVAL 3 MONTH)::DATE THEN 'test'
  WHEN ds > (last - INTERVAL 6 MONTH)::DATE THEN 'validation' ELSE 'train' END AS split FROM m""",
)
def p12(spark, sf):
    return p.split_by_months(daily_by(spark, sf).select("segment", "ds", "y"))


@query("p13_positive_frame", f"WITH {BALANCES} SELECT ds, y FROM balances WHERE y > 0")
def p13(spark, sf):
    return p.positive_series(balances(spark, sf), keys=())


@query("p14_complete_frame", f"WITH {TOTAL} SELECT segment, ds, y FROM series WHERE y IS NOT NULL")
def p14(spark, sf):
    return p.complete_series(daily_total(spark, sf))


@query(
    "p15_by_category",
    f"""WITH {COST} SELECT meter_category AS segment, usage_date, ROUND(SUM({COST_COL}), 4) AS daily_cost
FROM cost WHERE meter_category IN ('ECONOMY', 'PROMO', 'ABSENT') GROUP BY 1, 2""",
)
def p15(spark, sf):
    records = cost_records(spark, sf, ["usage_date", "meter_category", COST_COL])
    chosen = p.by_category(records, ["ECONOMY", "PROMO", "ABSENT"])
    return chosen.groupBy("segment", "usage_date").agg(F.round(F.sum(COST_COL), 4).alias("daily_cost"))


@query(
    "p16_log_target",
    f"WITH {SERIES} SELECT segment, ds, ROUND(ln(1 + y), 8) AS y_log, ROUND(y, 4) AS y FROM series",
)
def p16(spark, sf):
    logged = p.log_target(daily_by(spark, sf).select("segment", "ds", "y"))
    return rounded(rounded(p.unlog_target(logged), 8, "y_log"), 4, "y")


@query(
    "p17_difference",
    f"""WITH {SERIES}, a AS (SELECT segment, ds, y, y - LAG(y, 7) OVER ({DAYS}) AS d7, y - LAG(y) OVER ({DAYS}) AS d1 FROM series)
SELECT segment, ds, ROUND(d1, 4) AS first_diff, ROUND(d1 - LAG(d1) OVER ({DAYS}), 4) AS second_diff,
  ROUND(d7 - LAG(d7) OVER ({DAYS}), 4) AS seasonal_diff FROM a""",
)
def p17(spark, sf):
    daily = daily_by(spark, sf).select("segment", "ds", "y")
    out = p.difference(daily, 1, out_col="first_diff")
    out = p.difference(out, 2, out_col="second_diff")
    return rounded(p.difference(out, 1, 7, out_col="seasonal_diff").drop("y"))


@query(
    "p18_standardise",
    f"""WITH {SERIES}, {LABELLED}, s AS (SELECT segment, AVG(y) FILTER (split = 'train') AS m,
    STDDEV_POP(y) FILTER (split = 'train') AS d FROM labelled GROUP BY 1)
SELECT l.segment, ds, split, ROUND((y - m) / d, 6) AS y FROM labelled l JOIN s ON l.segment = s.segment""",
)
def p18(spark, sf):
    split = p.split_by_fraction(daily_by(spark, sf).select("segment", "ds", "y"))
    return rounded(p.standardise(split, ["y"], keys=["segment"]), 6)


@query("p19_stratified_sample")
def p19(spark, sf):
    keys = ["subscription_id", "line_number"]
    records = cost_records(spark, sf, [*keys, "meter_category"])
    return p.stratified_sample(records, 0.2, key_cols=keys)
