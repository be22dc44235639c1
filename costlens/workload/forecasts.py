"""Baseline and fitted forecasts of all segments."""

from __future__ import annotations

from pyspark.sql import functions as F

from costlens.models import arima, baseline, boosted, intervals, seasonal, stored
from costlens.operators.evaluate import align_on_date, best_model, metrics
from costlens.operators.prepare import split_boosted
from costlens.plans import forecast, train
from costlens.sources import cost_records
from costlens.workload.base import AS_OF, DAYS, SERIES, query, sig7, sig7_sql
from costlens.workload.evaluation import MEASURED, measured, series_frame

LAST = "last AS (SELECT segment, MAX(ds) AS last_ds FROM series GROUP BY 1)"
STEPS = f"{LAST}, fut AS (SELECT segment, last_ds, CAST(last_ds + CAST(s AS INT) AS DATE) AS ds, s AS step FROM last, (SELECT unnest(range(1, 91)) AS s))"


@query(
    "m1_naive",
    f"""WITH {SERIES}, {STEPS}, v AS (SELECT segment, arg_max(y, ds) AS yhat FROM series GROUP BY 1)
SELECT segment, ds, yhat FROM fut JOIN v USING (segment)""",
)
def m1_naive(spark, sf):
    return baseline.naive(series_frame(spark, sf), 90)


@query(
    "m1_moving_average",
    f"""WITH {SERIES}, {STEPS}, v AS (SELECT segment, AVG(y) AS yhat FROM (SELECT * FROM series
  QUALIFY ROW_NUMBER() OVER (PARTITION BY segment ORDER BY ds DESC) <= 28) GROUP BY 1)
SELECT segment, ds, {sig7_sql('yhat')} AS yhat FROM fut JOIN v USING (segment)""",
)
def m1_average(spark, sf):
    return sig7(baseline.moving_average(series_frame(spark, sf), 90, 28), "yhat")


@query(
    "m2_seasonal_naive",
    f"""WITH {SERIES}, {STEPS} SELECT f.segment, f.ds, y AS yhat FROM fut f LEFT JOIN series s
ON f.segment = s.segment AND s.ds = f.ds - CAST(ceil(step / 7.0) * 7 AS INT)""",
)
def m2(spark, sf):
    return baseline.seasonal_naive(series_frame(spark, sf), 90, 7)


@query(
    "m3_linear_trend",
    f"""WITH {SERIES}, {STEPS}, v AS (SELECT segment, regr_slope(y, (ds - DATE '1970-01-01')::DOUBLE) AS a,
  regr_intercept(y, (ds - DATE '1970-01-01')::DOUBLE) AS b FROM series GROUP BY 1)
SELECT segment, ds, {sig7_sql("b + a * (ds - DATE '1970-01-01')")} AS yhat FROM fut JOIN v USING (segment)""",
)
def m3(spark, sf):
    return sig7(baseline.linear_trend(series_frame(spark, sf), 90), "yhat")


@query(
    "m4_future_dates",
    f"""WITH {SERIES}, {LAST}, n AS (SELECT segment, last_ds, unnest(range(0, 12)) AS i FROM last)
SELECT segment, 'D' AS freq, CAST(last_ds + CAST(i + 1 AS INT) AS DATE) AS ds FROM n
UNION ALL SELECT segment, 'W', CAST(last_ds + CAST(7 - isodow(last_ds) % 7 + 7 * i AS INT) AS DATE) FROM n
UNION ALL SELECT segment, 'M', last_day((date_trunc('month', last_ds + 1) + to_months(CAST(i AS INT)))::DATE) FROM n""",
)
def m4(spark, sf):
    daily = series_frame(spark, sf)
    parts = [
        baseline.future_dates(daily, 12, freq).select("segment", F.lit(freq).alias("freq"), "ds") for freq in ("D", "W", "M")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "m4_future_frame",
    f"""WITH {SERIES}, {STEPS} SELECT segment, ds FROM series UNION ALL SELECT segment, ds FROM fut WHERE step <= 30""",
)
def m4_frame(spark, sf):
    return baseline.future_frame(series_frame(spark, sf), 30)


@query("m5_seasonal_forecast")
def m5(spark, sf):
    daily = series_frame(spark, sf)
    return seasonal.predict(seasonal.fit(daily), baseline.future_dates(daily, 90))


@query("m6_components")
def m6(spark, sf):
    daily = series_frame(spark, sf)
    return seasonal.components(seasonal.predict(seasonal.fit(daily), daily))


@query("m7_cross_validation")
def m7(spark, sf):
    return seasonal.cross_validate(series_frame(spark, sf))


@query("m8_holiday_effects")
def m8(spark, sf):
    daily = series_frame(spark, sf)
    ends = daily.filter(F.last_day("ds") == F.col("ds")).select("ds", F.lit("month_end").alias("holiday")).distinct()
    return seasonal.predict(seasonal.fit(daily, holidays=ends), daily, holidays=ends)


@query("m9_arima_forecast")
def m9(spark, sf):
    return arima.predict(arima.fit(series_frame(spark, sf)), 30)


OPTIONS = boosted.BoostedOptions()


@query(
    "m10_boosted_split",
    f"""WITH {SERIES}, n AS (SELECT segment, ds, ROW_NUMBER() OVER ({DAYS}) AS i, COUNT(*) OVER (PARTITION BY segment) AS n FROM series)
SELECT segment, CASE WHEN i <= floor(n * (1::DOUBLE - 0.2::DOUBLE - 0.1::DOUBLE)) THEN 'train'
  WHEN i <= floor(n * (1::DOUBLE - 0.2::DOUBLE)) THEN 'validation' ELSE 'test' END AS split, COUNT(*) AS days FROM n GROUP BY 1, 2""",
)
def m10_split(spark, sf):
    return split_boosted(series_frame(spark, sf)).groupBy("segment", "split").agg(F.count(F.lit(1)).alias("days"))


@query("m10_boosted_metrics")
def m10(spark, sf):
    daily = series_frame(spark, sf)
    test = boosted.labelled_rows(daily, OPTIONS).filter(F.col("split") == "test")
    scored = boosted.predict(boosted.fit(daily, OPTIONS), test)
    return metrics(align_on_date(scored, daily), ["segment"])


@query("m11_boosted_predictions")
def m11(spark, sf):
    daily = series_frame(spark, sf)
    return boosted.predict(boosted.fit(daily, OPTIONS), boosted.feature_rows(daily))


@query("m12_direct_forecast")
def m12(spark, sf):
    return boosted.direct_forecast(series_frame(spark, sf), 30, OPTIONS)


@query("m13_feature_importance")
def m13(spark, sf):
    return boosted.feature_importance(boosted.fit(series_frame(spark, sf), OPTIONS), spark)


@query("k4_top_features")
def k4(spark, sf):
    return boosted.feature_importance(boosted.fit(series_frame(spark, sf), OPTIONS), spark, 20)


@query("m14_grid_search")
def m14(spark, sf):
    _, tried = boosted.grid_search(series_frame(spark, sf), {"max_depth": [4, 6], "learning_rate": [0.05, 0.1]}, OPTIONS)
    return spark.createDataFrame(tried)


@query("m15_learning_curve")
def m15(spark, sf):
    daily = series_frame(spark, sf)
    return boosted.learning_curve(boosted.fit(daily, OPTIONS), boosted.labelled_rows(daily, OPTIONS), spark)


@query(
    "m16_forecasts_by_horizon",
    f"""WITH {SERIES}, {STEPS} SELECT f.segment, 'seasonal_naive' AS model, f.ds, y AS yhat, h AS horizon_days
FROM fut f LEFT JOIN series s ON f.segment = s.segment AND s.ds = f.ds - CAST(ceil(step / 7.0) * 7 AS INT),
  (SELECT unnest([30, 60, 90]) AS h) WHERE step <= h""",
)
def m16(spark, sf):
    out = baseline.seasonal_naive(series_frame(spark, sf), 90, 7).withColumn("model", F.lit("seasonal_naive"))
    return baseline.by_horizon(out, [30, 60, 90])


@query(
    "m17_best_model_by_segment",
    f"""WITH {MEASURED} SELECT segment, arg_min(model, mape) AS model FROM measured GROUP BY 1""",
)
def m17(spark, sf):
    return best_model(measured(spark, sf)).select("segment", "model")


@query(
    "m18_preliminary",
    f"""WITH {SERIES}, {STEPS} SELECT segment, ds, last_ds < TIMESTAMP '{AS_OF}' - INTERVAL 100 HOUR AS is_preliminary
FROM fut WHERE step <= 30""",
)
def m18(spark, sf):
    daily = series_frame(spark, sf)
    return baseline.mark_preliminary(baseline.naive(daily, 30), daily, AS_OF, 100).drop("yhat")


@query("m16_best_model_forecasts")
def m16_best(spark, sf):
    """Training run, model choice and forecasts of all segments."""
    result = train(cost_records(spark, sf), AS_OF)
    return forecast(result.daily, result.best, AS_OF)


def errors_sql(model: str, steps) -> str:
    """Absolute errors of a baseline over rolling origins, one SELECT per step."""
    parts = []
    for s in steps:
        k = -(-s // 7) * 7 if model == "seasonal_naive" else s
        told = f"LAG(b, {k}) OVER w + LAG(a, {k}) OVER w * x" if model == "linear_trend" else f"LAG(y, {k}) OVER w"
        parts.append(
            f"SELECT segment, ds, '{model}' AS model, {s} AS step, CASE WHEN ds - LAG(ds, {k}) OVER w = {k} THEN ABS(y - ({told})) END AS error FROM lines WINDOW w AS ({DAYS})"
        )
    return " UNION ALL ".join(parts)


LINES = f"""{SERIES}, days0 AS (SELECT segment, ds, y, (ds - MIN(ds) OVER (PARTITION BY segment))::DOUBLE AS x FROM series),
lines AS MATERIALIZED (SELECT *, regr_slope(y, x) OVER w AS a, regr_intercept(y, x) OVER w AS b FROM days0
  WINDOW w AS ({DAYS} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


def radius_sql(source: str, width: float) -> str:
    return f"""SELECT segment, model, step, error AS radius FROM (SELECT *, COUNT(*) OVER (PARTITION BY segment, model, step) AS n,
    ROW_NUMBER() OVER (PARTITION BY segment, model, step ORDER BY error) AS place FROM {source})
  WHERE place = LEAST(CEIL((n + 1) * {width}::DOUBLE), n)"""


COVERED_STEPS = (1, 7, 28)
BASELINES = ("naive", "seasonal_naive", "linear_trend")


@query(
    "g16_conformal_coverage",
    f"""WITH {LINES}, e AS ({' UNION ALL '.join(errors_sql(m, COVERED_STEPS) for m in BASELINES)}),
ends AS (SELECT segment, MIN(ds) + CAST(floor((MAX(ds) - MIN(ds)) * 0.8::DOUBLE) AS INT) AS cut FROM series GROUP BY 1),
dated AS (SELECT e.*, ds <= cut AS past FROM e JOIN ends USING (segment) WHERE error IS NOT NULL),
known AS (SELECT * FROM dated WHERE past), r AS ({radius_sql('known', 0.9)})
SELECT model, step, COUNT(*) AS n, COUNT_IF(error <= radius)::BIGINT AS inside, {sig7_sql('AVG((error <= radius)::INT)')} AS coverage
FROM dated d JOIN r USING (segment, model, step) WHERE NOT past GROUP BY 1, 2""",
)
def g16_conformal(spark, sf):
    """How many of the last days lie inside 90 % intervals measured on the days before."""
    daily = series_frame(spark, sf)
    ends = daily.groupBy("segment").agg(F.date_add(F.min("ds"), F.floor(F.datediff(F.max("ds"), F.min("ds")) * F.lit(0.8)).cast("int")).alias("cut"))
    out = None
    for model in BASELINES:
        errors = intervals.rolling_errors(daily, model, COVERED_STEPS).join(ends, "segment").withColumn("past", F.col("ds") <= F.col("cut"))
        radius = intervals.conformal_radius(errors.filter("past"), ["segment", "step"], 0.9).drop("n")
        inside = F.col("error") <= F.col("radius")
        frame = errors.filter("NOT past").join(radius, ["segment", "step"]).groupBy("step").agg(
            F.count(F.lit(1)).alias("n"), F.count_if(inside).alias("inside"), F.avg(inside.cast("double")).alias("coverage")
        )
        frame = frame.withColumn("model", F.lit(model))
        out = frame if out is None else out.unionByName(frame)
    return sig7(out, "coverage")


@query(
    "a5_forecast_bounds",
    f"""WITH {LINES}, {STEPS}, e AS (SELECT * FROM ({errors_sql('naive', intervals.STEPS)} UNION ALL {errors_sql('seasonal_naive', intervals.STEPS)}) WHERE error IS NOT NULL),
r AS MATERIALIZED ({radius_sql('e', 0.95)}), v AS (SELECT segment, arg_max(y, ds) AS level FROM series GROUP BY 1),
told AS (SELECT segment, 'naive' AS model, ds, step, level AS yhat FROM fut JOIN v USING (segment)
  UNION ALL SELECT f.segment, 'seasonal_naive', f.ds, step, y FROM fut f LEFT JOIN series s ON f.segment = s.segment AND s.ds = f.ds - CAST(ceil(step / 7.0) * 7 AS INT)),
far AS (SELECT segment, model, MAX(step) AS top, arg_max(radius, step) AS top_radius FROM r GROUP BY 1, 2),
near AS (SELECT t.segment, t.model, t.step, arg_min(radius, r.step) AS radius FROM told t JOIN r ON r.segment = t.segment AND r.model = t.model AND r.step >= t.step GROUP BY 1, 2, 3),
b AS (SELECT t.*, COALESCE(n.radius, top_radius * sqrt(t.step / top), 'inf'::DOUBLE) AS reach FROM told t
  LEFT JOIN near n ON n.segment = t.segment AND n.model = t.model AND n.step = t.step LEFT JOIN far f ON f.segment = t.segment AND f.model = t.model)
SELECT segment, model, ds, {sig7_sql('yhat')} AS yhat, {sig7_sql('yhat - reach')} AS yhat_lower, {sig7_sql('yhat + reach')} AS yhat_upper FROM b""",
)
def a5_bounds(spark, sf):
    """Forecasts of two baselines with their split-conformal intervals."""
    daily = series_frame(spark, sf)
    out = None
    for kind in ("naive", "seasonal_naive"):
        frame = stored.fit(kind, daily, (90,)).forecast((90,)).drop("horizon_days").withColumn("model", F.lit(kind))
        out = frame if out is None else out.unionByName(frame)
    return sig7(out, "yhat", "yhat_lower", "yhat_upper")
