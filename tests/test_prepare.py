from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from costlens.operators import prepare as p

NAN = float("nan")
D = dt.date


def test_fill_missing(spark):
    df = spark.createDataFrame(
        [(None, NAN, None, None), (1.0, 2.0, "a", '{"k":1}')],
        "cost_in_billing_currency double, quantity double, plan_name string, tags string",
    )
    rows = p.fill_missing(df).collect()
    assert tuple(rows[0]) == (0.0, 0.0, "Unknown", "{}")
    assert tuple(rows[1]) == (1.0, 2.0, "a", '{"k":1}')


def test_missing_rows_by_type(spark):
    df = spark.createDataFrame([(D(2024, 1, 1), "x", NAN), (None, "x", 1.0), (D(2024, 1, 1), "x", 1.0)], "d date, s string, v double")
    assert p.missing_rows(df, ["d", "s", "v", "absent"]).count() == 2


@pytest.mark.parametrize("raw", [False, True])
def test_p99_is_strict_and_exact(series_of, raw):
    daily = series_of({"s": range(1, 1001), "t": [5.0] * 10 + [None]})
    out = p.flag_outliers(daily, "y", "p99", raw=raw)
    flagged = sorted(r["y"] for r in out.filter("is_outlier").collect())
    assert flagged == [float(v) for v in range(991, 1001)]
    assert out.filter("is_outlier is null").count() == 1


def test_iqr(series_of):
    daily = series_of({"s": [10, 11, 12, 13, 14, 100, -80]})
    assert sorted(r["y"] for r in p.flag_outliers(daily, "y", "iqr").filter("is_outlier").collect()) == [-80, 100]


def test_zscore_without_spread_flags_nothing(series_of):
    daily = series_of({"flat": [3, 3, 3, 3], "one": [1], "spike": [1] * 30 + [100]})
    assert [r["y"] for r in p.flag_outliers(daily, "y", "zscore").filter("is_outlier").collect()] == [100]
    with pytest.raises(ValueError):
        p.flag_outliers(daily, "y", "magic")


def test_approximate_percentile_is_available(series_of):
    daily = series_of({"s": range(1, 101)})
    assert p.flag_outliers(daily, "y", "p99", exact=False).filter("is_outlier").count() == 1


def test_treatments(series_of):
    daily = series_of({"s": [*range(1, 100), 10_000]})
    cap = np.quantile([*range(1, 100), 10_000], 0.99)
    assert p.treat_outliers(daily, "y", "cap").agg(F.max("y")).first()[0] == pytest.approx(cap)
    assert p.treat_outliers(daily, "y", "remove").count() == 99
    assert p.treat_outliers(daily, "y", "flag").count() == 100
    with pytest.raises(ValueError):
        p.treat_outliers(daily, "y", "hide")


def gaps(spark):
    rows = [("s", D(2024, 1, 1), 1.0), ("s", D(2024, 1, 4), 4.0), ("s", D(2024, 1, 5), None), ("s", D(2024, 1, 7), 10.0), (None, D(2024, 1, 2), 7.0)]
    return spark.createDataFrame(rows, "segment string, ds date, y double")


def test_densify(spark):
    out = {(r["segment"], r["ds"].day): (r["y"], r["is_filled"]) for r in p.densify(gaps(spark)).collect()}
    assert len(out) == 8
    assert out["s", 2] == (0.0, True) and out["s", 5] == (0.0, False) and out[None, 2] == (7.0, False)


def test_forward_fill_and_interpolation(spark):
    spine = p.densify(gaps(spark).filter("segment is not null"), fill=None)
    filled = [r["y"] for r in p.forward_fill(spine).orderBy("ds").collect()]
    assert filled == [1, 1, 1, 4, 4, 4, 10]
    line = [r["y"] for r in p.interpolate(spine).orderBy("ds").collect()]
    assert line == pytest.approx([1, 2, 3, 4, 6, 8, 10])


def test_interpolation_leaves_the_edges(series_of):
    line = [r["y"] for r in p.interpolate(series_of({"s": [None, 1, None, 3, NAN]})).orderBy("ds").collect()]
    assert line == [None, 1, 2, 3, None]


def test_median_fill(series_of):
    out = p.fill_median(series_of({"s": [1, None, 3, NAN, 8]})).orderBy("ds").collect()
    assert [r["y"] for r in out] == [1, 3, 3, 3, 8]


def test_split_sizes(series_of):
    sizes = {1: (0, 0, 1), 3: (2, 0, 1), 10: (7, 1, 2), 20: (14, 3, 3), 101: (70, 15, 16)}
    daily = series_of({str(n): range(n) for n in sizes})
    counted = {(r["segment"], r["split"]): r["count"] for r in p.split_by_fraction(daily).groupBy("segment", "split").count().collect()}
    for n, expected in sizes.items():
        assert tuple(counted.get((str(n), s), 0) for s in ("train", "validation", "test")) == expected
        assert int(n * 0.7) == expected[0]
    with pytest.raises(ValueError):
        p.split_by_fraction(daily, 0.9, 0.2)


def test_split_boosted_uses_double_arithmetic(series_of):
    daily = series_of({"s": range(10)})
    counted = {r["split"]: r["count"] for r in p.split_boosted(daily).groupBy("split").count().collect()}
    assert counted["train"] == int(10 * (1 - 0.2 - 0.1)) and counted["test"] == 2


def test_split_by_months(series_of):
    out = p.split_by_months(series_of({"s": range(366)}))
    first = {r["split"]: r["min(ds)"] for r in out.groupBy("split").agg(F.min("ds")).collect()}
    assert first == {"train": D(2024, 1, 1), "validation": D(2024, 7, 1), "test": D(2024, 10, 1)}


def test_record_split_is_chronological_and_whole(spark):
    rows = [(D(2024, 1, 1 + i % 3), i) for i in range(300)]
    df = spark.createDataFrame(rows, "usage_date date, k int")
    out = p.split_records(df, tie_cols=["k"])
    counted = {r["split"]: r["count"] for r in out.groupBy("split").count().collect()}
    assert counted == {"train": 210, "validation": 45, "test": 45}
    bounds = {r["split"]: (r["lo"], r["hi"]) for r in out.groupBy("split").agg(F.min("usage_date").alias("lo"), F.max("usage_date").alias("hi")).collect()}
    assert bounds["train"][1] <= bounds["validation"][0] <= bounds["test"][0]


def test_record_split_keeps_copies_together(spark):
    df = spark.createDataFrame([(D(2024, 1, 1), 1)] * 60 + [(D(2024, 1, 2), 2)] * 40, "usage_date date, k int")
    counted = {r["split"]: r["count"] for r in p.split_records(df).groupBy("split").count().collect()}
    assert counted == {"train": 100}


def test_model_frames(series_of):
    daily = series_of({"s": [1, -1, 0, NAN, None]})
    assert [r["y"] for r in p.positive_series(daily).collect()] == [1]
    assert sorted(r["y"] for r in p.complete_series(daily).collect()) == [-1, 0, 1]


def test_differences(series_of):
    daily = series_of({"s": [1, 3, 6, 10, 15]})
    assert [r["y_diff"] for r in p.difference(daily, 2).orderBy("ds").collect()] == [None, None, 1, 1, 1]
    assert [r["y_diff"] for r in p.difference(daily, 0, 2).orderBy("ds").collect()] == [None, None, 5, 7, 9]


def test_standardise_fits_on_train_only(series_of):
    daily = series_of({"s": [1, 3, 100], "flat": [2, 2, 2]}).withColumn("split", F.when(F.dayofmonth("ds") < 3, "train").otherwise("test"))
    out = {(r["segment"], r["ds"].day): r["y"] for r in p.standardise(daily, ["y"], keys=["segment"]).collect()}
    assert out["s", 1] == -1 and out["s", 2] == 1 and out["s", 3] == 98 and out["flat", 3] == 0
    overall = p.standardise(daily.filter("segment = 's'"), ["y"]).orderBy("ds").collect()
    assert [r["y"] for r in overall] == [-1, 1, 98]


def test_log_round_trip(series_of):
    out = p.unlog_target(p.log_target(series_of({"s": [0, 5, 1e6]}))).orderBy("ds").collect()
    assert [r["y"] for r in out] == pytest.approx([0, 5, 1e6])


def test_stratified_sample_is_repeatable(spark):
    df = spark.range(10_000).select(F.col("id"), (F.col("id") % 4).cast("string").alias("meter_category"))
    sample = p.stratified_sample(df, 0.3, key_cols=["id"])
    counts = [r["count"] for r in sample.groupBy("meter_category").count().collect()]
    assert len(counts) == 4 and all(600 < c < 900 for c in counts)
    assert sample.count() == p.stratified_sample(df, 0.3, key_cols=["id"]).count()
