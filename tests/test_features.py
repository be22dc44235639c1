from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from costlens.operators import features as f

NAN = float("nan")


def test_calendar_equals_pandas(spark):
    days = spark.sql("select explode(sequence(date'2019-12-25', date'2025-01-10', interval 1 day)) as ds")
    got = f.temporal_features(days).toPandas().sort_values("ds").reset_index(drop=True)
    when = pd.to_datetime(got["ds"]).dt
    expected = {
        "Year": when.year, "Month": when.month, "Day": when.day, "DayOfWeek": when.dayofweek,
        "DayOfYear": when.dayofyear, "WeekOfYear": when.isocalendar().week, "Quarter": when.quarter,
        "IsWeekend": when.dayofweek >= 5, "IsMonthStart": when.is_month_start, "IsMonthEnd": when.is_month_end,
        "IsQuarterStart": when.is_quarter_start, "IsQuarterEnd": when.is_quarter_end,
    }
    for name, values in expected.items():
        assert (got[name].to_numpy() == values.to_numpy().astype(int)).all(), name
    assert np.allclose(got["DayOfWeek_sin"], np.sin(2 * np.pi * when.dayofweek / 7))
    assert np.allclose(got["DayOfYear_cos"], np.cos(2 * np.pi * when.dayofyear / 365))
    assert np.allclose(got["Month_sin"], np.sin(2 * np.pi * when.month / 12))


def pandas_rolling(values, windows=f.WINDOWS, shift=0):
    y = pd.Series([NAN if v is None else v for v in values], dtype=float).shift(shift)
    out = {}
    for w in windows:
        roll = y.rolling(w)
        out |= {f"y_rolling_mean_{w}": roll.mean(), f"y_rolling_std_{w}": roll.std(), f"y_rolling_max_{w}": roll.max(), f"y_rolling_min_{w}": roll.min()}
    return pd.DataFrame(out)


def check(spark, series_of, values, exclude):
    got = f.rolling_features(series_of({"s": values}), exclude_current=exclude).orderBy("ds").toPandas()
    want = pandas_rolling(values, shift=1 if exclude else 0)
    for name in want.columns:
        assert np.allclose(got[name].to_numpy(float), want[name].to_numpy(), equal_nan=True, rtol=1e-9, atol=1e-6), name


@pytest.mark.parametrize("exclude", [False, True])
def test_rolling_equals_pandas(spark, series_of, exclude):
    rng = np.random.default_rng(3)
    values = rng.normal(100, 20, 90).tolist()
    values[40], values[60] = None, NAN
    check(spark, series_of, values, exclude)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.floats(-1e4, 1e4)), min_size=1, max_size=45))
def test_rolling_equals_pandas_on_any_series(spark, series_of, values):
    check(spark, series_of, values, False)


def test_lags_stay_in_their_segment(series_of):
    daily = series_of({"a": [1, 2, 3], "b": [10, 20, 30]})
    out = {(r["segment"], r["ds"].day): (r["y_lag_1"], r["y_lag_2"]) for r in f.lag_features(daily, lags=[1, 2]).collect()}
    assert out["b", 1] == (None, None) and out["b", 3] == (20, 10) and out["a", 2] == (1, None)
    with pytest.raises(ValueError):
        f.lag_features(daily, lags=[0])


def test_derived_columns_depend_on_what_exists(spark):
    df = spark.createDataFrame([(10.0, 0.0, 5.0)], "y double, total_quantity double, y_lag_1 double")
    row = f.derived_features(df).first()
    assert row["CostPerUnit"] == pytest.approx(1e9)
    assert row["DayOverDayChange"] == 5 and row["DayOverDayPctChange"] == pytest.approx(100)
    assert "WeekOverWeekChange" not in row.asDict()
    zero = f.derived_features(df.withColumn("y_lag_1", F.lit(-1e-8))).first()
    assert zero["DayOverDayPctChange"] is None


def test_year_over_year_goes_by_date(series_of):
    out = f.year_over_year(series_of({"s": range(800)}, "2023-01-01"))
    row = out.filter("ds = date'2024-02-29'").first()
    assert row["y_last_year"] == 58 and row["YearOverYearChange"] == 424 - 58


def test_feature_frame_shares_one_shuffle(spark, series_of):
    daily = series_of({"a": range(40), "b": range(40)}).withColumn("total_quantity", F.lit(1.0))
    features = f.model_features(daily)
    assert len(features.columns) == 4 + 18 + 6 + 16 + 5
    plan = features._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort ") == 1


def test_fill(spark):
    df = spark.createDataFrame([(NAN, None)], "a double, b int")
    assert tuple(f.fill_features(df, ["a", "b"]).first()) == (0.0, 0)


def test_one_hot_drops_the_first_level(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), (None,)], "plan_name string")
    levels = f.fit_levels(df)
    assert levels == {"plan_name": ["a", "b", "c"]}
    out = f.one_hot(df, levels)
    assert out.columns == ["plan_name", "plan_name_b", "plan_name_c"]
    assert [tuple(r)[1:] for r in out.collect()] == [(1, 0), (0, 0), (0, 1), (0, 0)]
    unseen = spark.createDataFrame([("z",)], "plan_name string")
    assert tuple(f.one_hot(unseen, levels).first())[1:] == (0, 0)
    with pytest.raises(ValueError):
        f.fit_levels(df, limit=2)


def test_top_levels(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)] * 2 + [("c",)] * 2 + [("d",), (None,)], "consumed_service string")
    out = {r["consumed_service"]: r["count"] for r in f.top_levels(df, "consumed_service", 2).groupBy("consumed_service").count().collect()}
    assert out == {"a": 3, "b": 2, "Other": 4}


def test_align(spark):
    df = spark.createDataFrame([(1, 2)], "a int, extra int")
    assert f.align_columns(df, ["b", "a"]).first().asDict() == {"b": 0, "a": 1}


def test_correlated_pairs(spark):
    df = spark.range(100).select(F.col("id").alias("a"), (F.col("id") * 2).alias("b"), F.rand(1).alias("c"))
    rows = f.correlated_pairs(df, ["a", "b", "c"]).collect()
    assert [(r["feature_a"], r["feature_b"]) for r in rows] == [("a", "b")]
