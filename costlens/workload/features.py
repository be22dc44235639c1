"""Calendar, lag, rolling, change and categorical features."""

from __future__ import annotations

from pyspark.sql import functions as F

from costlens.functions.calendar import hours_between, months_by_days
from costlens.operators import features as f
from costlens.operators.duplicates import distinct_rows
from costlens.operators.prepare import complete_series, difference
from costlens.sources import cost_records
from costlens.workload.base import COST, DAYS, SERIES, TOTAL, daily_by, daily_total, query, rounded, sig7, sig7_sql, table

_CALENDAR = """year(ds)::INT AS "Year", month(ds)::INT AS "Month", day(ds)::INT AS "Day",
  (isodow(ds) - 1)::INT AS "DayOfWeek", dayofyear(ds)::INT AS "DayOfYear", week(ds)::INT AS "WeekOfYear",
  quarter(ds)::INT AS "Quarter", (isodow(ds) >= 6)::INT AS "IsWeekend",
  (day(ds) = 1)::INT AS "IsMonthStart", (last_day(ds) = ds)::INT AS "IsMonthEnd",
  (date_trunc('quarter', ds)::DATE = ds)::INT AS "IsQuarterStart",
  ((date_trunc('quarter', ds) + INTERVAL 3 MONTH - INTERVAL 1 DAY)::DATE = ds)::INT AS "IsQuarterEnd",
  ROUND(sin(2 * pi() * month(ds) / 12), 8) AS "Month_sin", ROUND(cos(2 * pi() * month(ds) / 12), 8) AS "Month_cos",
  ROUND(sin(2 * pi() * (isodow(ds) - 1) / 7), 8) AS "DayOfWeek_sin",
  ROUND(cos(2 * pi() * (isodow(ds) - 1) / 7), 8) AS "DayOfWeek_cos",
  ROUND(sin(2 * pi() * dayofyear(ds) / 365), 8) AS "DayOfYear_sin",
  ROUND(cos(2 * pi() * dayofyear(ds) / 365), 8) AS "DayOfYear_cos\""""


def _rolling(w, measures=("mean", "std", "max", "min"), shift=0):
    frame = f"OVER ({DAYS} ROWS BETWEEN {w - 1 + shift} PRECEDING AND {'CURRENT ROW' if not shift else f'{shift} PRECEDING'})"
    fn = {"mean": "AVG", "std": "STDDEV_SAMP", "max": "MAX", "min": "MIN"}
    out = []
    for m in measures:
        value = f"CASE WHEN COUNT(y) {frame} = {w} THEN {fn[m]}(y) {frame} END"
        out.append(f"{sig7_sql(value) if m in ('mean', 'std') else value} AS y_rolling_{m}_{w}")
    return ", ".join(out)


def _lags(lags):
    return ", ".join(f"LAG(y, {k}) OVER ({DAYS}) AS y_lag_{k}" for k in lags)


@query(
    "t0_flagship_features",
    f"""WITH {SERIES} SELECT segment, ds, y, (isodow(ds) - 1)::INT AS "DayOfWeek", (isodow(ds) >= 6)::INT AS "IsWeekend",
  {_lags((1, 7))}, {_rolling(7, ('mean',))} FROM series""",
)
def t0(spark, sf):
    daily = daily_by(spark, sf).select("segment", "ds", "y")
    out = f.rolling_features(f.lag_features(f.temporal_features(daily), lags=[1, 7]), windows=[7], measures=["mean"])
    out = out.select("segment", "ds", "y", "DayOfWeek", "IsWeekend", "y_lag_1", "y_lag_7", "y_rolling_mean_7")
    return sig7(out, "y_rolling_mean_7")


@query("t1_temporal", f"WITH {TOTAL} SELECT ds, {_CALENDAR} FROM series")
def t1(spark, sf):
    return rounded(f.temporal_features(daily_total(spark, sf).select("ds")), 8)


@query(
    "t12_cost_per_unit",
    f"""WITH {SERIES} SELECT segment, ds, {sig7_sql('y / (total_quantity + 1e-8)')} AS "CostPerUnit" FROM series""",
)
def t12(spark, sf):
    return sig7(f.derived_features(daily_by(spark, sf)).select("segment", "ds", "CostPerUnit"), "CostPerUnit")


@query("w1_lags", f"WITH {SERIES} SELECT segment, ds, {_lags((1, 2, 3, 7, 14, 30))} FROM series")
def w1(spark, sf):
    return f.lag_features(daily_by(spark, sf).select("segment", "ds", "y")).drop("y")


def _one_measure(measure):
    sql = f"WITH {SERIES} SELECT segment, ds, {', '.join(_rolling(w, (measure,)) for w in f.WINDOWS)} FROM series"

    def run(spark, sf):
        daily = daily_by(spark, sf).select("segment", "ds", "y")
        out = f.rolling_features(daily, measures=[measure]).drop("y")
        return sig7(out, *[f"y_rolling_{measure}_{w}" for w in f.WINDOWS]) if measure in ("mean", "std") else out

    return sql, run


for _name, _measure in (
    ("w2_rolling_mean", "mean"),
    ("w3_rolling_std", "std"),
    ("w4_rolling_max", "max"),
    ("w5_rolling_min", "min"),
):
    _sql, _run = _one_measure(_measure)
    query(_name, _sql)(_run)


@query(
    "w6_rolling_all",
    f"WITH {SERIES} SELECT segment, ds, {', '.join(_rolling(w, shift=1) for w in f.WINDOWS)} FROM series",
)
def w6(spark, sf):
    out = f.rolling_features(daily_by(spark, sf).select("segment", "ds", "y"), exclude_current=True).drop("y")
    return sig7(out, *[f"y_rolling_{m}_{w}" for w in f.WINDOWS for m in ("mean", "std")])


@query(
    "w7_total_windows",
    f"WITH {TOTAL} SELECT segment, ds, {_lags((1, 7))}, {_rolling(7)} FROM series",
)
def w7(spark, sf):
    daily = daily_total(spark, sf).select("segment", "ds", "y")
    out = f.rolling_features(f.lag_features(daily, lags=[1, 7]), windows=[7]).drop("y")
    return sig7(out, "y_rolling_mean_7", "y_rolling_std_7")


@query(
    "w13_first_difference",
    f"WITH {SERIES} SELECT segment, ds, ROUND(y - LAG(y) OVER ({DAYS}), 4) AS y_diff FROM series",
)
def w13(spark, sf):
    return rounded(difference(daily_by(spark, sf).select("segment", "ds", "y")).drop("y"))


_LAGGED = f"lagged AS (SELECT segment, ds, y, total_quantity, {_lags((1, 7, 30))} FROM series)"
_CHANGES = f"""ROUND(y - y_lag_1, 4) AS "DayOverDayChange",
  {sig7_sql('(y - y_lag_1) / (y_lag_1 + 1e-8) * 100.0')} AS "DayOverDayPctChange",
  ROUND(y - y_lag_7, 4) AS "WeekOverWeekChange", ROUND(y - y_lag_30, 4) AS "MonthOverMonthChange\""""
_CHANGE_COLUMNS = ("DayOverDayChange", "WeekOverWeekChange", "MonthOverMonthChange")


@query("w14_changes", f"WITH {SERIES}, {_LAGGED} SELECT segment, ds, {_CHANGES} FROM lagged")
def w14(spark, sf):
    out = f.derived_features(f.lag_features(daily_by(spark, sf).select("segment", "ds", "y"), lags=[1, 7, 30]))
    out = out.drop("y", "y_lag_1", "y_lag_7", "y_lag_30")
    return sig7(rounded(out, 4, *_CHANGE_COLUMNS), "DayOverDayPctChange")


@query(
    "w15_year_over_year",
    f"""WITH {SERIES} SELECT a.segment, a.ds, b.y AS y_last_year, ROUND(a.y - b.y, 4) AS "YearOverYearChange"
FROM series a LEFT JOIN series b ON a.segment = b.segment AND (a.ds - INTERVAL 12 MONTH)::DATE = b.ds""",
)
def w15(spark, sf):
    return rounded(f.year_over_year(daily_by(spark, sf).select("segment", "ds", "y")).drop("y"))


_ALL_COLUMNS = f"""segment, ds, y, total_quantity, {_CALENDAR}, {_lags(f.LAGS)},
  {', '.join(_rolling(w) for w in f.WINDOWS)}, {sig7_sql('y / (total_quantity + 1e-8)')} AS "CostPerUnit\""""


@query(
    "t14_model_features",
    f"""WITH {SERIES}, wide AS (SELECT {_ALL_COLUMNS} FROM series) SELECT *, {_CHANGES} FROM wide""",
)
def t14(spark, sf):
    out = f.model_features(daily_by(spark, sf).drop("avg_rate"))
    waves = [c for c in out.columns if c.endswith(("_sin", "_cos"))]
    means = [f"y_rolling_{m}_{w}" for w in f.WINDOWS for m in ("mean", "std")]
    out = rounded(rounded(out, 8, *waves), 4, *_CHANGE_COLUMNS)
    return sig7(out, *means, "CostPerUnit", "DayOverDayPctChange")


@query(
    "t15_fill_features",
    f"""WITH {SERIES} SELECT segment, ds, COALESCE(LAG(y, 7) OVER ({DAYS}), 0.0) AS y_lag_7,
  COALESCE(LAG(y, 30) OVER ({DAYS}), 0.0) AS y_lag_30 FROM series""",
)
def t15(spark, sf):
    lagged = f.lag_features(daily_by(spark, sf).select("segment", "ds", "y"), lags=[7, 30]).drop("y")
    return f.fill_features(lagged, ["y_lag_7", "y_lag_30"])


@query(
    "t16_one_hot",
    f"""WITH {COST} SELECT subscription_id, line_number,
  (meter_category = 'LARGE')::INT AS "meter_category_LARGE", (meter_category = 'MEDIUM')::INT AS "meter_category_MEDIUM",
  (meter_category = 'PROMO')::INT AS "meter_category_PROMO", (meter_category = 'SMALL')::INT AS "meter_category_SMALL",
  (meter_category = 'STANDARD')::INT AS "meter_category_STANDARD",
  (plan_name = 'N')::INT AS "plan_name_N", (plan_name = 'R')::INT AS "plan_name_R" FROM cost""",
)
def t16(spark, sf):
    records = cost_records(spark, sf, ["subscription_id", "line_number", "meter_category", "plan_name"])
    levels = f.fit_levels(records, ["meter_category", "plan_name"])
    return f.one_hot(records, levels).drop("meter_category", "plan_name")


@query(
    "t17_top_levels",
    f"""WITH {COST}, top AS (SELECT consumed_service FROM cost GROUP BY 1 ORDER BY COUNT(*) DESC, consumed_service LIMIT 5)
SELECT CASE WHEN consumed_service IN (SELECT consumed_service FROM top) THEN consumed_service ELSE 'Other' END AS service,
  COUNT(*) AS record_count FROM cost GROUP BY 1""",
)
def t17(spark, sf):
    grouped = f.top_levels(cost_records(spark, sf, ["consumed_service"]), "consumed_service", 5, "service")
    return grouped.groupBy("service").agg(F.count(F.lit(1)).alias("record_count"))


@query(
    "t18_correlated_pairs",
    """WITH c AS (SELECT corr(l_extendedprice, l_quantity) AS ab, corr(l_discount, l_extendedprice) AS bc,
  corr(l_extendedprice, l_extendedprice * (1 - l_discount)) AS pp, corr(l_discount, l_quantity) AS dq,
  corr(l_extendedprice * (1 - l_discount), l_quantity) AS nq, corr(l_discount, l_extendedprice * (1 - l_discount)) AS dn
  FROM lineitem),
p(feature_a, feature_b, correlation) AS (SELECT 'l_extendedprice', 'l_quantity', ab FROM c UNION ALL
  SELECT 'l_discount', 'l_extendedprice', bc FROM c UNION ALL SELECT 'l_extendedprice', 'net', pp FROM c UNION ALL
  SELECT 'l_discount', 'l_quantity', dq FROM c UNION ALL SELECT 'l_quantity', 'net', nq FROM c UNION ALL
  SELECT 'l_discount', 'net', dn FROM c)
SELECT feature_a, feature_b, ROUND(correlation, 8) AS correlation FROM p WHERE ABS(correlation) > 0.01""",
)
def t18(spark, sf):
    lines = table(spark, sf, "lineitem").withColumn("net", F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount")))
    return rounded(f.correlated_pairs(lines, ["l_quantity", "l_extendedprice", "l_discount", "net"], 0.01), 8)


@query("k1_sorted_series", f"WITH {SERIES} SELECT segment, ds, y FROM series ORDER BY segment, ds")
def k1(spark, sf):
    return complete_series(daily_by(spark, sf)).orderBy("segment", "ds")


@query(
    "s1_distinct_rows",
    """SELECT * REPLACE (CAST(l_shipdate AS DATE) AS l_shipdate) FROM (SELECT DISTINCT * FROM (
SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_linenumber = 1))""",
)
def s1(spark, sf):
    lines = table(spark, sf, "lineitem")
    whole = distinct_rows(lines.unionByName(lines.filter("l_linenumber = 1")))
    return whole.withColumn("l_shipdate", F.to_date("l_shipdate"))


@query(
    "s7_half_even_rounding",
    """SELECT l_orderkey, l_linenumber, round_even(l_quantity / 4, 1) AS quarter FROM lineitem""",
)
def s7(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.bround(F.col("l_quantity") / 4, 1).alias("quarter")
    )


@query(
    "s8_elapsed_time",
    """SELECT o_orderkey, (epoch(TIMESTAMP '2001-11-08') - epoch(o_orderdate)) / 3600.0 AS hours_old,
  floor((epoch(TIMESTAMP '2001-11-08') - epoch(o_orderdate)) / 86400.0) / 30.0 AS months_old FROM orders""",
)
def s8(spark, sf):
    now = F.lit("2001-11-08 00:00:00").cast("timestamp")
    placed = F.col("o_orderdate")
    return table(spark, sf, "orders").select(
        "o_orderkey", hours_between(now, placed).alias("hours_old"), months_by_days(now, placed).alias("months_old")
    )
