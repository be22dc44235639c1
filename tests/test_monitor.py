from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from costlens.operators import monitor as m

AS_OF = "2024-07-01 00:00:00"
T = dt.datetime


def history(spark, mapes, model="m"):
    rows = [(model, T(2024, 6, 1) + dt.timedelta(days=i), float(v), 0.5) for i, v in enumerate(mapes)]
    return m.check_accuracy(spark.createDataFrame(rows, "model string, checked_at timestamp, mape double, r2 double"))


def test_trends_need_seven_checks(spark):
    rows = m.performance_trends(history(spark, range(1, 10)), AS_OF).orderBy("checked_at").collect()
    assert [r["mape_trend"] for r in rows] == [None] * 6 + [4, 5, 6]
    assert m.performance_trends(history(spark, [1] * 6), AS_OF).filter("mape_trend is not null").count() == 0


def test_trends_keep_models_apart(spark):
    both = history(spark, [1] * 7, "a").unionByName(history(spark, [9] * 7, "b"))
    out = {r["model"]: r["mape_trend"] for r in m.performance_trends(both, AS_OF).filter("mape_trend is not null").collect()}
    assert out == {"a": 1, "b": 9}


def test_recent_includes_the_boundary(spark):
    assert m.recent(history(spark, [1, 2, 3]), "2024-07-02 00:00:00", 30).count() == 2


def test_report(spark):
    row = m.performance_report(history(spark, [5, 13, 20, float("nan")])).first()
    assert (row["status"], row["total_checks"]) == ("ok", 4)
    assert (row["critical_alerts"], row["warning_alerts"], row["ok_alerts"]) == (1, 1, 2)
    assert row["average_mape"] == pytest.approx(38 / 3) and row["meets_target_pct"] == 25
    empty = m.performance_report(history(spark, [1]).limit(0)).first()
    assert empty["status"] == "no_data" and empty["total_checks"] == 0 and empty["meets_target_pct"] == 0


def test_consecutive_alerts(spark):
    values = [13, 5, 13, 14, 5, 16, 5]
    rows = [("m", dt.date(2024, 1, 1 + i), float(v)) for i, v in enumerate(values)]
    out = m.consecutive_alerts(spark.createDataFrame(rows, "model string, ds date, mape double")).orderBy("from_day").collect()
    assert [(r["from_day"].day, r["run_days"], r["alert_level"]) for r in out] == [(3, 2, "WARNING"), (6, 1, "CRITICAL")]


@pytest.mark.parametrize(
    "days,mape,triggers",
    [
        (None, None, ["initial_training"]),
        (29, 10.0, []),
        (30, 0.0, ["monthly_schedule"]),
        (90, None, ["monthly_schedule", "quarterly_schedule"]),
        (180, 15.0, ["time_based", "monthly_schedule", "quarterly_schedule"]),
        (10, 15.1, ["performance_degradation"]),
        (10, float("nan"), []),
    ],
)
def test_retraining_triggers(spark, days, mape, triggers):
    last = None if days is None else T(2024, 7, 1) - dt.timedelta(days=days)
    df = spark.createDataFrame([("m", mape, last)], "model string, current_mape double, last_retraining timestamp")
    row = m.retraining_decision(df, AS_OF).first()
    assert row["triggers"] == triggers and row["should_retrain"] is bool(triggers)


def test_retraining_switches_and_drift(spark):
    df = spark.createDataFrame([("m", 1.0, T(2024, 1, 1)), ("n", 1.0, T(2024, 6, 30))], "model string, current_mape double, last_retraining timestamp")
    drift = spark.createDataFrame([("n", False), ("n", True)], "model string, is_drift boolean")
    out = {r["model"]: r["triggers"] for r in m.retraining_decision(df, AS_OF, monthly=False, quarterly=False, drift=drift).collect()}
    assert out == {"m": ["time_based"], "n": ["data_drift"]}


def test_history_tables(spark, tmp_path):
    path = str(tmp_path / "retraining")
    models = spark.createDataFrame([("m",)], "model string")
    m.append_history(m.schedule_rows(models, F.lit("2024-02-01"), F.lit("2024-01-01")), path)
    m.append_history(m.schedule_rows(models, F.lit("2024-02-02"), F.lit("2024-02-02"), "completed"), path)
    stored = spark.read.parquet(path)
    assert m.latest_schedule(stored).first()["status"] == "completed"
    assert m.last_retraining(stored).first()["last_retraining"] == T(2024, 2, 2)


def test_monitoring_run(spark, series_of):
    from costlens.plans import monitor

    actual = series_of({"s": [100, 100]})
    forecasts = actual.withColumn("yhat", F.col("y") * 1.2).drop("y").withColumn("model", F.lit("m"))
    retrainings = m.schedule_rows(spark.createDataFrame([("m",)], "model string"), F.lit("2024-06-25"), F.lit("2024-06-25"), "completed")
    result = monitor(forecasts, actual, history(spark, [5] * 8), retrainings, AS_OF)
    assert result.checks.first()["alert_level"] == "CRITICAL"
    assert result.decision.first()["triggers"] == ["performance_degradation"]
    assert result.report.first()["total_checks"] == 9
    assert result.trends.count() == 9


def test_several_checks_on_one_day_make_one_day(spark):
    import datetime as dt

    from costlens.operators import monitor as m

    rows = [("a", dt.date(2024, 1, 1), 13.0), ("a", dt.date(2024, 1, 1), 13.5), ("a", dt.date(2024, 1, 2), 13.0), ("a", dt.date(2024, 1, 3), float("nan"))]
    out = m.consecutive_alerts(spark.createDataFrame(rows, "model string, ds date, mape double")).collect()
    assert [(r["run_days"], r["worst_mape"], r["alert_level"]) for r in out] == [(2, 13.5, "WARNING")]
