"""Forecast accuracy, comparison and ensembles of one-step forecasts."""

from __future__ import annotations

from pyspark.sql import functions as F

from costlens.models.baseline import rolling_naive
from costlens.models.seasonal import fold_frame
from costlens.operators import evaluate as e
from costlens.operators.features import rolling_features
from costlens.operators.prepare import flag_outliers
from costlens.workload.base import DAYS, SERIES, TOTAL, daily_by, daily_total, query, rounded, sig7, sig7_sql, table

MODELS = ("lag1", "lag7", "mean7")


def series_frame(spark, sf):
    return daily_by(spark, sf).select("segment", "ds", "y")


def one_step(daily):
    """One-step forecasts of three baselines for every day with enough past."""
    mean7 = (
        rolling_features(daily, windows=[7], exclude_current=True, measures=["mean"])
        .select("segment", "ds", F.round("y_rolling_mean_7", 4).alias("yhat"))
        .filter(F.col("yhat").isNotNull())
    )
    return e.stack_models({"lag1": rolling_naive(daily, lag=1), "lag7": rolling_naive(daily, lag=7), "mean7": mean7})


ONE_STEP = f"""fc AS (SELECT * FROM (
  SELECT segment, 'lag1' AS model, ds, LAG(y, 1) OVER ({DAYS}) AS yhat FROM series
  UNION ALL SELECT segment, 'lag7', ds, LAG(y, 7) OVER ({DAYS}) FROM series
  UNION ALL SELECT segment, 'mean7', ds, CASE WHEN COUNT(y) OVER w = 7 THEN ROUND(AVG(y) OVER w, 4) END FROM series
    WINDOW w AS ({DAYS} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)) WHERE yhat IS NOT NULL)"""
PAIRS = f"{SERIES}, {ONE_STEP}, pairs AS (SELECT segment, model, ds, yhat, y FROM fc JOIN series USING (segment, ds))"


def metrics_sql(y="y", f="yhat"):
    """Metric columns over pairs that are all finite; NaN reads as null."""
    return f"""COUNT({y}) AS n, SQRT(AVG(({y} - {f}) * ({y} - {f}))) AS rmse, AVG(ABS({y} - {f})) AS mae,
  AVG(ABS(({y} - {f}) / ({y} + 1e-8))) * 100 AS mape,
  CASE WHEN COUNT({y}) < 2 THEN NULL WHEN VAR_POP({y}) > 0
    THEN 1 - SUM(({y} - {f}) * ({y} - {f})) / (VAR_POP({y}) * COUNT({y}))
    WHEN SUM(({y} - {f}) * ({y} - {f})) = 0 THEN 1.0 ELSE 0.0 END AS r2,
  CASE WHEN AVG({y}) > 0 THEN AVG(ABS({y} - {f})) / AVG({y}) * 100 END AS mae_percentage"""


SHOWN = ", ".join(f"{sig7_sql(m)} AS {m}" for m in e.METRICS)
MEASURED = f"{PAIRS}, measured AS (SELECT segment, model, {metrics_sql()} FROM pairs GROUP BY 1, 2)"


def pairs(spark, sf):
    daily = series_frame(spark, sf)
    return e.align_on_date(one_step(daily), daily)


def measured(spark, sf):
    return e.metrics(pairs(spark, sf))


def shown(df):
    return sig7(df, *[m for m in e.METRICS if m in df.columns])


@query("j1_forecast_actual_join", f"WITH {PAIRS} SELECT segment, model, ds, yhat, y FROM pairs")
def j1(spark, sf):
    return pairs(spark, sf)


@query(
    "j2_complete_pairs",
    f"""WITH {PAIRS} SELECT segment, model, ds, yhat, y FROM pairs WHERE y > 50000""",
)
def j2(spark, sf):
    daily = series_frame(spark, sf)
    low = F.col("y") <= 50000
    holes = daily.withColumn("y", F.when(low & (F.dayofmonth("ds") % 2 == 0), None).when(low, F.lit(float("nan"))).otherwise(F.col("y")))
    return e.align_complete(one_step(daily), holes)


_BY_POSITION = f"""{SERIES}, {ONE_STEP},
  a AS (SELECT segment, y, ROW_NUMBER() OVER ({DAYS}) AS position FROM series),
  b AS (SELECT segment, model, ds, yhat, ROW_NUMBER() OVER (PARTITION BY segment, model ORDER BY ds) AS position FROM fc)"""


@query(
    "j3_position_join",
    f"""WITH {_BY_POSITION} SELECT segment, model, ds, yhat, position::INT AS position, y
FROM b JOIN a USING (segment, position)""",
)
def j3(spark, sf):
    daily = series_frame(spark, sf)
    return e.align_by_position(one_step(daily), daily)


@query(
    "j9_fold_frame",
    f"""WITH {SERIES}, b AS (SELECT segment, MIN(ds) AS lo, MAX(ds) AS hi FROM series GROUP BY 1),
c AS (SELECT segment, hi, unnest(range(0, ((hi - 30) - (lo + 180)) // 30 + 1)) AS i FROM b),
k AS (SELECT segment, CAST(hi - 30 - CAST(i * 30 AS INT) AS DATE) AS cutoff FROM c)
SELECT s.segment, cutoff, CASE WHEN ds <= cutoff THEN 'train' ELSE 'test' END AS role, COUNT(*) AS days,
  ROUND(SUM(y), 4) AS total FROM series s JOIN k ON s.segment = k.segment AND ds <= cutoff + 30 GROUP BY 1, 2, 3""",
)
def j9(spark, sf):
    folds = fold_frame(series_frame(spark, sf))
    return folds.groupBy("segment", "cutoff", "role").agg(
        F.count(F.lit(1)).alias("days"), F.round(F.sum("y"), 4).alias("total")
    )


@query(
    "j10_attach_statistics",
    f"""WITH {TOTAL} SELECT segment, ds, y, y > (SELECT quantile_cont(y, 0.99) FROM series) AS is_outlier FROM series""",
)
def j10(spark, sf):
    return flag_outliers(daily_total(spark, sf).select("segment", "ds", "y"), "y", "p99", keys=())


@query("e1_metrics", f"WITH {MEASURED} SELECT segment, model, n, {SHOWN} FROM measured")
def e1(spark, sf):
    return shown(measured(spark, sf))


@query(
    "e2_evaluate_by_date",
    f"""WITH {MEASURED} SELECT segment, model, n, {SHOWN}, mape < 60 AS meets_mape_target, r2 > -1 AS meets_r2_target
FROM measured""",
)
def e2(spark, sf):
    daily = series_frame(spark, sf)
    return shown(e.evaluate(one_step(daily), daily, target_mape=60.0, target_r2=-1.0))


@query(
    "e3_metrics_by_horizon",
    f"""WITH {PAIRS}, n AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY segment, model ORDER BY ds) AS i FROM pairs),
m AS (SELECT segment, model, h::INT AS horizon, {metrics_sql()} FROM n, (SELECT unnest([1, 7, 30, 90, 100000]) AS h)
  WHERE i <= h GROUP BY 1, 2, 3 HAVING COUNT(*) = h::INT)
SELECT segment, model, horizon, n, {SHOWN} FROM m""",
)
def e3(spark, sf):
    return shown(e.metrics_by_horizon(pairs(spark, sf), [1, 7, 30, 90, 100000]))


@query(
    "w12_horizon_windows",
    f"""WITH {PAIRS}, n AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY segment, model ORDER BY ds) AS i FROM pairs)
SELECT segment, model, h::INT AS horizon, COUNT(*) AS n FROM n, (SELECT unnest([7, 30, 100000]) AS h)
WHERE i <= h GROUP BY 1, 2, 3 HAVING COUNT(*) = h::INT""",
)
def w12(spark, sf):
    return e.metrics_by_horizon(pairs(spark, sf), [7, 30, 100000]).select("segment", "model", "horizon", "n")


@query(
    "e4_rounded_summary",
    f"""WITH {MEASURED} SELECT segment, model, n, round_even(rmse, 2) AS rmse, round_even(mae, 2) AS mae,
  round_even(mape, 2) AS mape, round_even(r2, 2) AS r2, round_even(mae_percentage, 2) AS mae_percentage FROM measured""",
)
def e4(spark, sf):
    return e.rounded_summary(measured(spark, sf), 2)


@query(
    "e5_evaluate_by_position",
    f"""WITH {_BY_POSITION}, m AS (SELECT segment, model, {metrics_sql()} FROM b JOIN a USING (segment, position) GROUP BY 1, 2)
SELECT segment, model, n, {SHOWN}, mape < 10 AS meets_mape_target, r2 > 0.8 AS meets_r2_target FROM m""",
)
def e5(spark, sf):
    daily = series_frame(spark, sf)
    return shown(e.evaluate(one_step(daily), daily, by="position"))


_SCENARIOS = """sc AS (SELECT segment, ds, yhat, 'base' AS scenario FROM fc WHERE model = 'lag7'
  UNION ALL SELECT segment, ds, yhat * 1.1, 'plus_10' FROM fc WHERE model = 'lag7'
  UNION ALL SELECT segment, ds, yhat * 0.9, 'minus_10' FROM fc WHERE model = 'lag7')"""


@query(
    "e6_sensitivity",
    f"""WITH {SERIES}, {ONE_STEP}, {_SCENARIOS}, m AS (SELECT segment, scenario, {metrics_sql()}
  FROM sc JOIN series USING (segment, ds) GROUP BY 1, 2) SELECT segment, scenario, n, {SHOWN} FROM m""",
)
def e6(spark, sf):
    daily = series_frame(spark, sf)
    base = rolling_naive(daily, lag=7)
    scale = lambda factor: base.withColumn("yhat", F.col("yhat") * factor)
    return shown(e.sensitivity(base, {"plus_10": scale(1.1), "minus_10": scale(0.9)}, daily))


@query(
    "e7_delayed_data",
    f"""WITH {SERIES} SELECT segment, d::INT AS delay, COUNT(*) AS days, MAX(ds) AS last_day
FROM (SELECT *, MAX(ds) OVER (PARTITION BY segment) AS newest FROM series), (SELECT unnest([1, 3, 7]) AS d)
WHERE ds <= newest - d::INT GROUP BY 1, 2""",
)
def e7_delay(spark, sf):
    daily = series_frame(spark, sf)
    out = None
    for delay in (1, 3, 7):
        late = e.delay_days(daily, delay).groupBy("segment").agg(
            F.lit(delay).alias("delay"), F.count(F.lit(1)).alias("days"), F.max("ds").alias("last_day")
        )
        out = late if out is None else out.unionByName(late)
    return out.select("segment", "delay", "days", "last_day")


@query("e7_perturbed_data")
def e7_perturbed(spark, sf):
    """Accuracy of the seven-day baseline on damaged histories."""
    daily = series_frame(spark, sf)
    damaged = {f"missing_{p}": e.drop_days(daily, p) for p in (5, 10, 20)} | {"outliers_5": e.inflate_days(daily, 5, 3.0)}
    forecasts = {name: rolling_naive(frame, lag=7) for name, frame in damaged.items()}
    return e.sensitivity(rolling_naive(daily, lag=7), forecasts, daily)


@query(
    "e8_benchmark",
    f"""WITH {MEASURED} SELECT m.segment, m.model, n, {', '.join(f"{sig7_sql('m.' + k)} AS {k}" for k in e.METRICS)},
  {sig7_sql('(b.rmse - m.rmse) / b.rmse * 100')} AS rmse_improvement_pct,
  {sig7_sql('(b.mape - m.mape) / b.mape * 100')} AS mape_improvement_pct
FROM measured m JOIN (SELECT segment, rmse, mape FROM measured WHERE model = 'lag1') b ON m.segment = b.segment""",
)
def e8(spark, sf):
    out = e.benchmark(measured(spark, sf), "lag1")
    return sig7(shown(out), "rmse_improvement_pct", "mape_improvement_pct")


_RANKED = f"""{MEASURED}, ranked AS (SELECT *,
  RANK() OVER (PARTITION BY segment ORDER BY mape) + (COUNT(*) OVER (PARTITION BY segment, mape) - 1) / 2.0::DOUBLE AS mape_rank,
  RANK() OVER (PARTITION BY segment ORDER BY r2 DESC) + (COUNT(*) OVER (PARTITION BY segment, r2) - 1) / 2.0::DOUBLE AS r2_rank
  FROM measured)"""


@query(
    "e9_compare_models",
    f"""WITH {_RANKED} SELECT segment, model, n, {SHOWN}, mape < 10 AS meets_mape_target, r2 > 0.8 AS meets_r2_target,
  mape_rank, r2_rank, (mape_rank + r2_rank) / 2 AS overall_rank FROM ranked""",
)
def e9(spark, sf):
    daily = series_frame(spark, sf)
    return shown(e.compare_models(one_step(daily), daily))


@query(
    "w10_average_rank",
    """WITH c AS (SELECT n_regionkey AS segment, n_name AS model, (COUNT(s_suppkey) % 4)::DOUBLE AS m
  FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY 1, 2),
k AS (SELECT segment, model, CASE WHEN m <> 3 THEN m END AS mape FROM c)
SELECT segment, model, CASE WHEN mape IS NOT NULL THEN RANK() OVER (PARTITION BY segment ORDER BY mape NULLS LAST)
  + (COUNT(*) OVER (PARTITION BY segment, mape) - 1) / 2.0::DOUBLE END AS mape_rank FROM k""",
)
def w10(spark, sf):
    """Ranks with ties and NaN: nations by their number of suppliers modulo 4."""
    suppliers = table(spark, sf, "nation").join(
        table(spark, sf, "supplier"), F.col("s_nationkey") == F.col("n_nationkey"), "left"
    )
    counted = suppliers.groupBy(F.col("n_regionkey").alias("segment"), F.col("n_name").alias("model")).agg(
        (F.count("s_suppkey") % 4).cast("double").alias("m")
    )
    scored = counted.withColumn("mape", F.when(F.col("m") == 3, F.lit(float("nan"))).otherwise(F.col("m")))
    return scored.withColumn("mape_rank", e.average_rank("mape")).drop("m", "mape")


def _best_sql(metric, order):
    return f"""WITH {MEASURED} SELECT segment, model, {sig7_sql(metric)} AS {metric} FROM measured
QUALIFY ROW_NUMBER() OVER (PARTITION BY segment ORDER BY {metric} {order}, model) = 1"""


@query("k2_best_model_mape", _best_sql("mape", "ASC"))
def k2_mape(spark, sf):
    return shown(e.best_model(measured(spark, sf)).select("segment", "model", "mape"))


@query("k2_best_model_r2", _best_sql("r2", "DESC"))
def k2_r2(spark, sf):
    return shown(e.best_model(measured(spark, sf), "r2").select("segment", "model", "r2"))


@query(
    "s2_stacked_models",
    f"WITH {SERIES}, {ONE_STEP} SELECT model, COUNT(*) AS forecasts FROM fc GROUP BY 1",
)
def s2(spark, sf):
    return one_step(series_frame(spark, sf)).groupBy("model").agg(F.count(F.lit(1)).alias("forecasts"))


@query(
    "e10_ensemble_equal",
    f"""WITH {SERIES}, {ONE_STEP} SELECT segment, ds, {sig7_sql('SUM(yhat / 3.0)')} AS yhat FROM fc
GROUP BY 1, 2 HAVING COUNT(*) = 3""",
)
def e10_equal(spark, sf):
    return sig7(e.ensemble(one_step(series_frame(spark, sf))), "yhat")


@query(
    "e10_ensemble_weighted",
    f"""WITH {SERIES}, {ONE_STEP} SELECT segment, ds,
  {sig7_sql("SUM(yhat * CASE model WHEN 'lag1' THEN 2.0 WHEN 'lag7' THEN 1.0 ELSE 0.0 END / 4.0)")} AS yhat
FROM fc GROUP BY 1, 2 HAVING COUNT(*) = 3""",
)
def e10_weighted(spark, sf):
    weights = spark.createDataFrame([("lag1", 2.0), ("lag7", 1.0), ("absent", 1.0)], "model string, weight double")
    return sig7(e.ensemble(one_step(series_frame(spark, sf)), weights), "yhat")


_WEIGHTS = "w AS (SELECT segment, model, (1 / mape) / SUM(1 / mape) OVER (PARTITION BY segment) AS weight FROM measured)"


@query("e11_weights", f"WITH {MEASURED}, {_WEIGHTS} SELECT segment, model, ROUND(weight, 7) AS weight FROM w")
def e11(spark, sf):
    return rounded(e.performance_weights(measured(spark, sf)), 7)


@query(
    "e11_weighted_ensemble",
    f"""WITH {MEASURED}, {_WEIGHTS}, x AS (SELECT segment, ds, SUM(yhat * weight) AS yhat FROM fc JOIN w USING (segment, model)
  GROUP BY 1, 2 HAVING COUNT(*) = 3) SELECT segment, ds, {sig7_sql('yhat')} AS yhat FROM x""",
)
def e11_ensemble(spark, sf):
    return sig7(e.ensemble(one_step(series_frame(spark, sf)), e.performance_weights(measured(spark, sf))), "yhat")


@query(
    "e12_best_by_horizon",
    f"""WITH {PAIRS}, n AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY segment, model ORDER BY ds) AS i FROM pairs),
m AS (SELECT segment, model, h::INT AS horizon, {metrics_sql()} FROM n, (SELECT unnest([7, 30, 90]) AS h)
  WHERE i <= h GROUP BY 1, 2, 3 HAVING COUNT(*) = h::INT)
SELECT segment, horizon, model, {sig7_sql('mape')} AS mape FROM m
QUALIFY ROW_NUMBER() OVER (PARTITION BY segment, horizon ORDER BY mape, model) = 1""",
)
def e12(spark, sf):
    by_horizon = e.metrics_by_horizon(pairs(spark, sf), [7, 30, 90])
    return shown(e.best_model(by_horizon, keys=["segment", "horizon"]).select("segment", "horizon", "model", "mape"))


@query(
    "e13_challenge",
    f"""WITH {MEASURED} SELECT c.segment, {sig7_sql('c.mape')} AS candidate_mape, {sig7_sql('c.rmse')} AS candidate_rmse,
  {sig7_sql('c.r2')} AS candidate_r2, {sig7_sql('p.mape')} AS production_mape, {sig7_sql('p.rmse')} AS production_rmse,
  {sig7_sql('p.r2')} AS production_r2, c.mape < p.mape AS candidate_wins
FROM measured c JOIN measured p ON c.segment = p.segment AND c.model = 'mean7' AND p.model = 'lag1'""",
)
def e13(spark, sf):
    out = e.challenge(measured(spark, sf), "mean7", "lag1")
    return sig7(out, *[c for c in out.columns if c.startswith(("candidate_", "production_")) and c != "candidate_wins"])


@query(
    "g16_interval_coverage",
    f"""WITH {PAIRS} SELECT segment, model, ROUND(AVG((y BETWEEN yhat * 0.5 AND yhat * 1.5)::INT), 6) AS coverage
FROM pairs GROUP BY 1, 2""",
)
def g16(spark, sf):
    banded = pairs(spark, sf).withColumns({"yhat_lower": F.col("yhat") * 0.5, "yhat_upper": F.col("yhat") * 1.5})
    return rounded(e.interval_coverage(banded), 6)
