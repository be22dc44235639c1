from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from costlens.operators import evaluate as e
from costlens.operators.monitor import check_accuracy

NAN, INF = float("nan"), float("inf")


def measure(pairs):
    return e.metrics(pairs).first().asDict()


def test_perfect_prediction(pairs_of):
    m = measure(pairs_of([100, 200, 300, 400], [100, 200, 300, 400]))
    assert m["rmse"] == 0 and m["mae"] == 0 and m["mape"] < 1 and m["r2"] == pytest.approx(1)


def test_errors(pairs_of):
    m = measure(pairs_of([100, 200, 300], [110, 180, 330]))
    assert m["rmse"] == pytest.approx(math.sqrt((100 + 400 + 900) / 3))
    assert m["mae"] == pytest.approx(20)
    assert m["mape"] == pytest.approx((0.1 + 0.1 + 0.1) / 3 * 100, rel=1e-6)
    assert m["r2"] == pytest.approx(1 - 1400 / 20000)
    assert m["mae_percentage"] == pytest.approx(10)


def test_nan_pairs_are_left_out(pairs_of):
    m = measure(pairs_of([100, NAN, 300, 400], [110, 190, NAN, 410]))
    assert m["n"] == 2 and m["rmse"] == pytest.approx(10)


def test_infinite_pairs_are_left_out(pairs_of):
    m = measure(pairs_of([100, INF, 300], [110, 1, -INF]))
    assert m["n"] == 1


def test_no_finite_pair_gives_nan(pairs_of):
    m = measure(pairs_of([NAN, NAN], [NAN, NAN]))
    assert m["n"] == 0 and all(math.isnan(m[k]) for k in e.METRICS)


def test_zero_actual_keeps_mape_finite(pairs_of):
    m = measure(pairs_of([0, 100, 200], [10, 110, 190]))
    assert math.isfinite(m["mape"]) and m["mape"] > 1e6


def test_constant_series_rules(pairs_of):
    assert measure(pairs_of([5, 5, 5], [5, 5, 5]))["r2"] == 1.0
    assert measure(pairs_of([5, 5, 5], [5, 5, 6]))["r2"] == 0.0


def test_negative_mean_has_no_percentage(pairs_of):
    assert math.isnan(measure(pairs_of([-5, -6], [-5, -5]))["mae_percentage"])


def test_horizons(pairs_of):
    random.seed(1)
    actual, level = [], 100.0
    for _ in range(100):
        level += random.gauss(0, 1)
        actual.append(level)
    pairs = pairs_of(actual, [v + random.gauss(0, 1) for v in actual])
    out = {r["horizon"]: r for r in e.metrics_by_horizon(pairs, [1, 7, 30]).collect()}
    assert set(out) == {1, 7, 30}
    assert math.isnan(out[1]["r2"])


def test_horizon_longer_than_the_data_is_left_out(pairs_of):
    pairs = pairs_of(range(1, 11), range(1, 11))
    assert {r["horizon"] for r in e.metrics_by_horizon(pairs, [1, 7, 30, 90]).collect()} == {1, 7}
    with pytest.raises(ValueError):
        e.metrics_by_horizon(pairs, [0])


def measured_of(spark):
    rows = [("s", "prophet", 10.5, 8.2, 5.3, 0.95), ("s", "arima", 12.1, 9.5, 6.2, 0.92), ("s", "boosted", 9.8, 7.9, 4.8, 0.97)]
    return spark.createDataFrame(rows, "segment string, model string, rmse double, mae double, mape double, r2 double")


def test_summary_is_rounded_half_even(spark):
    out = e.rounded_summary(measured_of(spark).withColumn("mae", F.lit(0.00005)), 4).collect()
    assert len(out) == 3 and all(r["mae"] == 0.0 for r in out)


def test_ranking_and_choice(spark):
    ranked = {r["model"]: r for r in e.rank_models(measured_of(spark)).collect()}
    assert ranked["boosted"]["overall_rank"] == 1 and ranked["arima"]["overall_rank"] == 3
    assert e.best_model(measured_of(spark), "r2").first()["model"] == "boosted"
    with pytest.raises(ValueError):
        e.best_model(measured_of(spark), "speed")


def test_ranks_share_ties_and_skip_nan(spark):
    rows = [("s", "a", 1.0), ("s", "b", 1.0), ("s", "c", 2.0), ("s", "d", NAN)]
    df = spark.createDataFrame(rows, "segment string, model string, mape double")
    out = {r["model"]: r["rank"] for r in df.withColumn("rank", e.average_rank("mape")).collect()}
    assert out == {"a": 1.5, "b": 1.5, "c": 3.0, "d": None}


def test_nan_never_wins(spark):
    rows = [("s", "a", NAN, NAN), ("s", "b", 50.0, -3.0)]
    df = spark.createDataFrame(rows, "segment string, model string, mape double, r2 double")
    assert e.best_model(df, "r2").first()["model"] == "b"
    assert e.best_model(df, "mape").first()["model"] == "b"


def test_ties_go_to_the_first_name(spark):
    rows = [("s", "b", 1.0), ("s", "a", 1.0)]
    df = spark.createDataFrame(rows, "segment string, model string, mape double")
    assert e.best_model(df).first()["model"] == "a"


def test_flags_reject_nan(spark):
    df = spark.createDataFrame([("s", "m", NAN, NAN)], "segment string, model string, mape double, r2 double")
    row = e.target_flags(df).first()
    assert row["meets_mape_target"] is False and row["meets_r2_target"] is False
    row = check_accuracy(df).first()
    assert (row["alert_level"], row["meets_target"], row["is_evaluable"]) == ("OK", False, False)


def test_alert_levels(spark):
    df = spark.createDataFrame([("a", 15.1), ("b", 15.0), ("c", 12.0), ("d", 9.9)], "model string, mape double")
    out = {r["model"]: (r["alert_level"], r["meets_target"]) for r in check_accuracy(df).collect()}
    assert out == {"a": ("CRITICAL", False), "b": ("WARNING", False), "c": ("OK", False), "d": ("OK", True)}


def test_position_alignment_cuts_to_the_shorter(spark, series_of):
    actual = series_of({"s": [1, 2, 3]})
    forecast = series_of({"s": [10, 20]}, "2030-01-01").withColumnRenamed("y", "yhat").withColumn("model", F.lit("m"))
    rows = e.align_by_position(forecast, actual).orderBy("position").collect()
    assert [(r["yhat"], r["y"]) for r in rows] == [(10, 1), (20, 2)]


def test_ensemble_weights(spark, series_of):
    a = series_of({"s": [10, 20, 30]}).withColumnRenamed("y", "yhat")
    b = series_of({"s": [20, 40]}).withColumnRenamed("y", "yhat")
    stacked = e.stack_models({"a": a, "b": b})
    equal = [r["yhat"] for r in e.ensemble(stacked).orderBy("ds").collect()]
    assert equal == pytest.approx([15, 30])
    weights = spark.createDataFrame([("a", 1.0), ("z", 3.0)], "model string, weight double")
    assert [r["yhat"] for r in e.ensemble(stacked, weights).orderBy("ds").collect()] == pytest.approx([2.5, 5.0])
    by_position = e.ensemble(stacked, by="position").orderBy("position").collect()
    assert [r["yhat"] for r in by_position] == pytest.approx([15, 30])


def test_performance_weights_sum_to_one(spark):
    out = e.performance_weights(measured_of(spark)).collect()
    assert sum(r["weight"] for r in out) == pytest.approx(1)
    assert max(out, key=lambda r: r["weight"])["model"] == "boosted"


def test_benchmark_improvement(spark):
    out = {r["model"]: r for r in e.benchmark(measured_of(spark), "arima").collect()}
    assert out["arima"]["mape_improvement_pct"] == 0
    assert out["boosted"]["mape_improvement_pct"] == pytest.approx((6.2 - 4.8) / 6.2 * 100)


def test_sensitivity_scenarios(series_of):
    actual = series_of({"s": [100, 110, 120]})
    base = actual.withColumnRenamed("y", "yhat")
    out = {r["scenario"]: r for r in e.sensitivity(base, {"up": base.withColumn("yhat", F.col("yhat") * 1.1)}, actual).collect()}
    assert out["base"]["mape"] == pytest.approx(0) and out["up"]["mape"] == pytest.approx(10)


def test_segment_without_overlap_has_no_row(series_of):
    actual = series_of({"a": [1, 2], "b": [1, 2]})
    forecast = series_of({"a": [1, 2]}).withColumnRenamed("y", "yhat").withColumn("model", F.lit("m"))
    assert [r["segment"] for r in e.evaluate(forecast, actual).collect()] == ["a"]


def test_scenario_frames(series_of):
    daily = series_of({"s": range(1, 201)})
    kept = e.drop_days(daily, 20).count()
    assert 130 < kept < 190 and kept == e.drop_days(daily, 20).count()
    assert e.delay_days(daily, 3).count() == 197
    assert e.inflate_days(daily, 100, 2.0).agg(F.sum("y")).first()[0] == 2 * sum(range(1, 201))


def test_a_perfect_model_takes_the_weight(spark):
    from costlens.operators.evaluate import performance_weights

    rows = [("s", "perfect", 0.0), ("s", "good", 5.0), ("s", "none", float("nan"))]
    out = {r["model"]: r["weight"] for r in performance_weights(spark.createDataFrame(rows, "segment string, model string, mape double")).collect()}
    assert out["perfect"] > 0.99 and 0 < out["good"] < 0.01 and out["none"] is None
