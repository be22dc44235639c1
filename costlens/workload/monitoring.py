"""Accuracy history, alerts, retraining decisions."""

from __future__ import annotations

from pyspark.sql import functions as F

from costlens.operators import monitor as m
from costlens.operators.drift import ks_drift
from costlens.operators.evaluate import metrics
from costlens.workload.base import AS_OF, query, rounded, sig7, sig7_sql, table
from costlens.workload.drift import _KS, FEATURES, halves
from costlens.workload.evaluation import PAIRS, SHOWN, metrics_sql, pairs, shown

WARN, CRIT, TARGET = 80.0, 90.0, 70.0


def history(spark, sf):
    """One check per model and month, dated at the end of the month."""
    monthly = pairs(spark, sf).withColumn("checked_at", F.last_day("ds").cast("timestamp"))
    return m.check_accuracy(metrics(monthly, ["model", "checked_at"]), WARN, CRIT, TARGET)


HISTORY = f"""{PAIRS}, monthly AS (SELECT *, last_day(ds)::TIMESTAMP AS checked_at FROM pairs),
checks AS (SELECT model, checked_at, {metrics_sql()} FROM monthly GROUP BY 1, 2),
history AS (SELECT *, CASE WHEN mape > {CRIT} THEN 'CRITICAL' WHEN mape > {WARN} THEN 'WARNING' ELSE 'OK' END AS alert_level,
  mape < {TARGET} AS meets_target, mape IS NOT NULL AS is_evaluable FROM checks)"""


def _utc(df):
    """Timestamps without zone, as the files hold them."""
    return df.withColumns({f.name: F.col(f.name).cast("timestamp_ntz") for f in df.schema if f.dataType.typeName() == "timestamp"})


@query("r1_accuracy_checks", f"WITH {HISTORY} SELECT model, checked_at, n, {SHOWN}, alert_level, meets_target, is_evaluable FROM history")
def r1(spark, sf):
    return _utc(shown(history(spark, sf)))


@query("f9_recent_history", f"""WITH {HISTORY} SELECT model, checked_at, alert_level FROM history
WHERE checked_at >= TIMESTAMP '{AS_OF}' - INTERVAL 200 DAY""")
def f9(spark, sf):
    return _utc(m.recent(history(spark, sf), AS_OF, 200).select("model", "checked_at", "alert_level"))


_TREND = f"""recent AS (SELECT * FROM history WHERE checked_at >= TIMESTAMP '{AS_OF}' - INTERVAL 365 DAY),
trend AS (SELECT model, checked_at, CASE WHEN COUNT(mape) OVER w = 7 THEN AVG(mape) OVER w END AS mape_trend,
  CASE WHEN COUNT(r2) OVER w = 7 THEN AVG(r2) OVER w END AS r2_trend FROM recent
  WINDOW w AS (PARTITION BY model ORDER BY checked_at ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))"""


@query("w8_rolling_accuracy", f"WITH {HISTORY}, {_TREND} SELECT model, checked_at, {sig7_sql('mape_trend')} AS mape_trend FROM trend")
def w8(spark, sf):
    return _utc(sig7(m.performance_trends(history(spark, sf), AS_OF, 365).select("model", "checked_at", "mape_trend"), "mape_trend"))


@query("w9_performance_trends", f"""WITH {HISTORY}, {_TREND} SELECT model, checked_at, {sig7_sql('mape_trend')} AS mape_trend,
  {sig7_sql('r2_trend')} AS r2_trend FROM trend""")
def w9(spark, sf):
    out = m.performance_trends(history(spark, sf), AS_OF, 365).select("model", "checked_at", "mape_trend", "r2_trend")
    return _utc(sig7(out, "mape_trend", "r2_trend"))


_REPORT = f"""CASE WHEN COUNT(*) > 0 THEN 'ok' ELSE 'no_data' END AS status, COUNT(*) AS total_checks,
  {sig7_sql('AVG(mape)')} AS average_mape, {sig7_sql('AVG(r2)')} AS average_r2, {sig7_sql('MIN(mape)')} AS min_mape,
  {sig7_sql('MAX(mape)')} AS max_mape, COUNT_IF(alert_level = 'CRITICAL')::BIGINT AS critical_alerts,
  COUNT_IF(alert_level = 'WARNING')::BIGINT AS warning_alerts, COUNT_IF(alert_level = 'OK')::BIGINT AS ok_alerts,
  ROUND(COUNT_IF(meets_target) * 100.0 / COUNT(*)::DOUBLE, 6) AS meets_target_pct"""
_REPORT_COLUMNS = ("average_mape", "average_r2", "min_mape", "max_mape")


@query("g14_performance_report", f"WITH {HISTORY} SELECT {_REPORT} FROM history")
def g14(spark, sf):
    return rounded(sig7(m.performance_report(history(spark, sf)), *_REPORT_COLUMNS), 6, "meets_target_pct")


@query(
    "g17_monthly_report",
    f"WITH {HISTORY} SELECT date_trunc('month', checked_at)::DATE AS period_start, {_REPORT} FROM history GROUP BY 1",
)
def g17(spark, sf):
    out = m.performance_report(history(spark, sf), "month")
    return rounded(sig7(out, *_REPORT_COLUMNS), 6, "meets_target_pct")


@query(
    "w16_consecutive_alerts",
    f"""WITH {PAIRS}, d AS (SELECT model, ds, AVG(ABS((y - yhat) / (y + 1e-8))) * 100 AS mape FROM pairs GROUP BY 1, 2),
i AS (SELECT *, ds - CAST(ROW_NUMBER() OVER (PARTITION BY model ORDER BY ds) AS INT) AS g FROM d WHERE mape > 100),
r AS (SELECT model, MIN(ds) AS from_day, MAX(ds) AS to_day, COUNT(*) AS run_days, MAX(mape) AS worst FROM i GROUP BY model, g)
SELECT model, from_day, to_day, run_days, {sig7_sql('worst')} AS worst_mape,
  CASE WHEN worst > 300 THEN 'CRITICAL' ELSE 'WARNING' END AS alert_level FROM r WHERE worst > 300 OR run_days >= 2""",
)
def w16(spark, sf):
    return sig7(m.consecutive_alerts(metrics(pairs(spark, sf), ["model", "ds"]), 100.0, 300.0), "worst_mape")


def model_states(spark, sf):
    """A customer is a model: the last order is the last retraining, the share
    of open orders the error. Orders are summed up before they meet customers."""
    orders = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("model")).agg(
        (F.avg((F.col("o_orderstatus") == "O").cast("double")) * 100.0).alias("error"),
        F.max("o_orderdate").alias("last_order"),
    )
    nation = F.col("c_nationkey")
    known = orders.join(table(spark, sf, "customer").select("c_custkey", "c_nationkey"), F.col("model") == F.col("c_custkey"))
    return known.select(
        "model",
        F.when(nation % 7 == 0, F.lit(float("nan"))).otherwise(F.col("error")).alias("current_mape"),
        F.when(nation % 5 > 0, F.date_sub("last_order", nation * 10)).cast("timestamp").alias("last_retraining"),
    )


STATES = """states AS (SELECT o_custkey AS model, CASE WHEN MAX(c_nationkey) % 7 > 0
    THEN AVG((o_orderstatus = 'O')::INT::DOUBLE) * 100.0 END AS current_mape,
  (MAX(CASE WHEN c_nationkey % 5 > 0 THEN o_orderdate END)::DATE - CAST(MAX(c_nationkey) * 10 AS INT))::TIMESTAMP AS last_retraining
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1)"""


def _decision_sql(extra_join="", extra_rule=""):
    return f"""WITH {STATES}{extra_join}, t AS (SELECT *, floor((epoch(TIMESTAMP '{AS_OF}') - epoch(last_retraining)) / 86400.0) / 30.0 AS months FROM states),
c AS (SELECT model, months, list_filter([CASE WHEN current_mape <> 0 AND current_mape > 15 THEN 'performance_degradation' END,
  CASE WHEN months >= 6 THEN 'time_based' END, CASE WHEN months >= 1 THEN 'monthly_schedule' END,
  CASE WHEN months >= 3 THEN 'quarterly_schedule' END, CASE WHEN last_retraining IS NULL THEN 'initial_training' END{extra_rule}],
  lambda x: x IS NOT NULL) AS triggers FROM t)
SELECT model, ROUND(months, 6) AS months_since, array_to_string(triggers, ',') AS triggers, len(triggers) > 0 AS should_retrain FROM c"""


def _decided(df):
    shown_ = df.select("model", "months_since", F.array_join("triggers", ",").alias("triggers"), "should_retrain")
    return rounded(shown_, 6, "months_since")


@query("r2_retraining_decision", _decision_sql())
def r2(spark, sf):
    return _decided(m.retraining_decision(model_states(spark, sf), AS_OF))


@query(
    "r4_drift_trigger",
    _decision_sql(
        ", drifted AS (SELECT o_custkey AS model, bool_or(o_totalprice > 480000) AS is_drift FROM orders GROUP BY 1)",
        ", CASE WHEN COALESCE((SELECT is_drift FROM drifted d WHERE d.model = t.model), FALSE) THEN 'data_drift' END",
    ),
)
def r4(spark, sf):
    drift = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("model"), (F.col("o_totalprice") > 480000).alias("is_drift")
    )
    return _decided(m.retraining_decision(model_states(spark, sf), AS_OF, drift=drift))


@query(
    "r4_feature_drift_flags",
    f"WITH {_KS} SELECT feature AS model, pvalue < 0.05 AS is_drift FROM p",
)
def r4_flags(spark, sf):
    return ks_drift(*halves(spark, sf), FEATURES).select(F.col("feature").alias("model"), "is_drift")


def retraining_history(spark, sf):
    """Retraining rows from orders: the customer is the model."""
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("model"),
        F.col("o_orderdate").cast("timestamp").alias("scheduled_date"),
        F.when(F.col("o_orderstatus") == "F", "completed").otherwise("scheduled").alias("status"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"),
    )


RETRAININGS = """h AS (SELECT o_custkey AS model, o_orderdate AS scheduled_date,
  CASE WHEN o_orderstatus = 'F' THEN 'completed' ELSE 'scheduled' END AS status, o_orderdate AS created_at FROM orders)"""


@query(
    "r3_last_retraining",
    f"WITH {RETRAININGS} SELECT model, MAX(scheduled_date) AS last_retraining FROM h WHERE status = 'completed' GROUP BY 1",
)
def r3_last(spark, sf):
    return _utc(m.last_retraining(retraining_history(spark, sf)))


@query(
    "r3_latest_schedule",
    f"""WITH {RETRAININGS} SELECT model, scheduled_date, status, created_at FROM h
QUALIFY ROW_NUMBER() OVER (PARTITION BY model ORDER BY created_at DESC, scheduled_date DESC, status DESC) = 1""",
)
def r3_latest(spark, sf):
    return _utc(m.latest_schedule(retraining_history(spark, sf)))
