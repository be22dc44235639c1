from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from costlens.operators import drift as d
from costlens.operators.order_stats import cumulative_counts, exact_quantiles
from costlens.operators.residuals import autocorrelation, jarque_bera, ljung_box

RNG = np.random.default_rng(11)


def frame(spark, values, name="v"):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], f"{name} double")


def ks(a, b):
    a, b = np.sort(a), np.sort(b)
    at = np.concatenate([a, b])
    return np.max(np.abs(np.searchsorted(a, at, "right") / len(a) - np.searchsorted(b, at, "right") / len(b)))


def test_ks_equals_numpy(spark):
    a, b = RNG.normal(0, 1, 3000).round(2), RNG.normal(0.1, 1.2, 2000).round(2)
    row = d.ks_drift(frame(spark, a), frame(spark, b), ["v"]).first()
    assert row["statistic"] == pytest.approx(ks(a, b), abs=1e-12)
    assert row["is_drift"] is True
    assert row["drift_magnitude"] == pytest.approx(abs(b.mean() - a.mean()) / a.std(ddof=1))


def test_ks_identical_shifted_disjoint(spark):
    a = RNG.normal(0, 1, 400)
    same = d.distribution_drift(frame(spark, a), frame(spark, a), "v").first()
    assert same["statistic"] == 0 and same["pvalue"] == 1 and same["is_drift"] is False
    far = d.distribution_drift(frame(spark, a), frame(spark, a + 100), "v").first()
    assert far["statistic"] == 1 and far["pvalue"] < 1e-9


def test_ks_ignores_missing_and_survives_flat_baseline(spark):
    row = d.ks_drift(frame(spark, [5, 5, None, float("nan")]), frame(spark, [5, 6]), ["v"]).first()
    assert row["n_baseline"] == 2 and row["drift_magnitude"] == 0


def test_drift_arguments(spark):
    a = frame(spark, [1, 2])
    with pytest.raises(ValueError):
        d.distribution_drift(a, a, "w")
    with pytest.raises(ValueError):
        d.distribution_drift(a, a, "v", method="magic")
    with pytest.raises(ValueError):
        d.describe_baseline(a, ["w"])


def test_several_features_in_one_plan_skip_absent_ones(spark):
    a = frame(spark, range(50)).withColumn("w", F.col("v") * 2)
    out = d.ks_drift(a, a.withColumn("v", F.col("v") + 40), ["v", "w", "gone"]).collect()
    assert {r["feature"]: r["is_drift"] for r in out} == {"v": True, "w": False}


def test_chi2(spark):
    a = spark.createDataFrame([("x",)] * 60 + [("y",)] * 40, "c string")
    b = spark.createDataFrame([("x",)] * 40 + [("y",)] * 60, "c string")
    row = d.distribution_drift(a, b, "c", "chi2").first()
    assert row["statistic"] == pytest.approx(8.0) and row["dof"] == 1
    assert row["pvalue"] == pytest.approx(0.004677734981, rel=1e-8)


def test_psi_is_zero_without_change(spark):
    a = frame(spark, RNG.normal(0, 1, 2000))
    assert d.psi(a, a, ["v"]).first()["psi"] == pytest.approx(0, abs=1e-12)
    assert d.psi(a, a.withColumn("v", F.col("v") + 2), ["v"]).first()["psi"] > 1


def test_mann_whitney_with_ties(spark):
    a, b = [1, 2, 2, 3, 5, 5], [2, 4, 5, 6, 6]
    row = d.mann_whitney(frame(spark, a), frame(spark, b), ["v"]).first()
    u = sum((y > x) + 0.5 * (y == x) for x in a for y in b)
    assert row["u"] == u and 0 < row["pvalue"] < 1


def test_new_values(spark):
    a = spark.createDataFrame([("x",), (None,)], "c string")
    b = spark.createDataFrame([("x",), ("y",), ("y",), (None,)], "c string")
    assert [tuple(r) for r in d.new_values(a, b, "c").collect()] == [("y", 2)]


def test_season_and_trend(series_of):
    flat = series_of({"s": [10] * 70})
    weekly = series_of({"s": [10 + 5 * (i % 7 == 0) for i in range(70)]}, "2024-06-03")
    assert d.season_profile_shift(flat, flat).first()["psi"] == pytest.approx(0)
    assert d.season_profile_shift(flat, weekly).first()["psi"] > 0
    rising = series_of({"s": range(70)})
    assert d.trend_shift(flat, rising).first()["slope_change"] == pytest.approx(1)


@pytest.mark.parametrize("narrow", [False, True])
@pytest.mark.parametrize("size", [1, 2, 3, 7, 100, 2500])
def test_quantiles_equal_numpy(spark, size, narrow):
    values = RNG.integers(0, max(2, size // 2), size).astype(float)
    chances = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = exact_quantiles(frame(spark, values), "v", chances, narrow=narrow).first()["quantiles"]
    assert got == pytest.approx(np.quantile(values, chances).tolist(), abs=1e-9)


def test_narrowed_quantiles_on_many_rows(spark):
    df = spark.range(200_000).select(
        (F.col("id") % 2).alias("k"),
        # A third of all rows is one value.
        F.when(F.col("id") % 3 == 0, F.lit(7.5)).otherwise(F.exp(F.rand(5) * 9)).alias("v"),
    ).cache()
    chances = [0.25, 0.5, 0.99, 0.9999]
    got = {r["k"]: r["quantiles"] for r in exact_quantiles(df, "v", chances, ["k"], narrow=True).collect()}
    pdf = df.toPandas()
    for k, part in pdf.groupby("k"):
        assert got[k] == pytest.approx(np.quantile(part["v"], chances).tolist(), rel=1e-12)


def test_running_counts_with_null_keys_and_a_hot_value(spark):
    df = spark.createDataFrame([(None, 1.0)] * 5000 + [("a", float(i)) for i in range(500)], "k string, v double")
    rows = cumulative_counts(df, "v", ["k"]).collect()
    hot = [r for r in rows if r["k"] is None]
    assert len(hot) == 1 and (hot[0]["n"], hot[0]["cum_n"], hot[0]["total_n"]) == (5000, 5000, 5000)
    rest = sorted((r["value"], r["cum_n"]) for r in rows if r["k"] == "a")
    assert rest == [(float(i), i + 1) for i in range(500)]


def residuals(series_of, values):
    return series_of({"s": values}).withColumnRenamed("y", "residual")


def test_autocorrelation_equals_numpy(series_of):
    x = RNG.normal(0, 1, 200)
    got = {r["lag"]: r["acf"] for r in autocorrelation(residuals(series_of, x), 3).collect()}
    c = x - x.mean()
    for k in (1, 2, 3):
        assert got[k] == pytest.approx(np.sum(c[k:] * c[:-k]) / np.sum(c * c))


def test_ljung_box_tells_noise_from_memory(series_of):
    noise = ljung_box(residuals(series_of, RNG.normal(0, 1, 500))).first()
    walk = ljung_box(residuals(series_of, np.cumsum(RNG.normal(0, 1, 500)))).first()
    assert noise["is_white_noise"] is True and walk["is_white_noise"] is False
    odd = ljung_box(residuals(series_of, RNG.normal(0, 1, 500)), lags=5).first()
    assert 0 <= odd["pvalue"] <= 1


def test_jarque_bera(series_of):
    assert jarque_bera(residuals(series_of, RNG.normal(0, 1, 800))).first()["is_normal"] is True
    assert jarque_bera(residuals(series_of, RNG.exponential(1, 800))).first()["is_normal"] is False
