from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from costlens.models import arima, baseline, boosted, seasonal, stationarity

RNG = np.random.default_rng(5)
D = dt.date


def weekly_series(n=400, noise=1.0, trend=0.1):
    t = np.arange(n)
    return 200 + trend * t + 20 * np.sin(2 * np.pi * t / 7) + RNG.normal(0, noise, n)


# ---- baselines ----


def test_naive_and_average(series_of):
    daily = series_of({"s": [1, 2, 3, None], "t": [7]})
    rows = {(r["segment"], r["ds"]): r["yhat"] for r in baseline.naive(daily, 2).collect()}
    assert rows["s", D(2024, 1, 4)] == 3 and rows["t", D(2024, 1, 3)] == 7
    mean = baseline.moving_average(daily, 1, 2).filter("segment = 's'").first()
    assert mean["yhat"] == 2.5


def test_seasonal_naive_by_date(series_of):
    daily = series_of({"s": range(1, 15)})
    out = [r["yhat"] for r in baseline.seasonal_naive(daily, 9, 7).orderBy("ds").collect()]
    assert out == [8, 9, 10, 11, 12, 13, 14, 8, 9]


def test_linear_trend(series_of):
    out = baseline.linear_trend(series_of({"s": [1, 2, 3]}), 2).orderBy("ds").collect()
    assert [r["yhat"] for r in out] == pytest.approx([4, 5])


@pytest.mark.parametrize(
    "last,freq,expected",
    [
        ("2024-01-31", "M", [D(2024, 2, 29), D(2024, 3, 31)]),
        ("2024-01-30", "M", [D(2024, 1, 31), D(2024, 2, 29)]),
        ("2024-01-07", "W", [D(2024, 1, 14), D(2024, 1, 21)]),
        ("2024-01-08", "W", [D(2024, 1, 14), D(2024, 1, 21)]),
        ("2024-02-28", "D", [D(2024, 2, 29), D(2024, 3, 1)]),
    ],
)
def test_future_dates(series_of, last, freq, expected):
    out = baseline.future_dates(series_of({"s": [1]}, last), 2, freq).orderBy("ds").collect()
    assert [r["ds"] for r in out] == expected
    assert baseline.future_frame(series_of({"s": [1]}, last), 2, freq).count() == 3


def test_future_date_arguments(series_of):
    with pytest.raises(ValueError):
        baseline.future_dates(series_of({"s": [1]}), 0)
    with pytest.raises(ValueError):
        baseline.future_dates(series_of({"s": [1]}), 1, "Y")


def test_horizons_and_late_flag(series_of):
    daily = series_of({"s": [1]})
    forecasts = baseline.naive(daily, 5).withColumn("model", F.lit("naive"))
    out = {r["horizon_days"]: r["count"] for r in baseline.by_horizon(forecasts, [2, 5]).groupBy("horizon_days").count().collect()}
    assert out == {2: 2, 5: 5}
    late = lambda at: baseline.mark_preliminary(forecasts, daily, at).first()["is_preliminary"]
    assert late("2024-01-03 00:00:00") is False and late("2024-01-03 01:00:00") is True


# ---- seasonal regression ----


def test_seasonal_recovers_a_weekly_pattern(series_of):
    y = weekly_series(730)
    daily = series_of({"a": y[:700], "b": 2 * y[:700]})
    coefficients = seasonal.fit(daily)
    out = seasonal.predict(coefficients, baseline.future_dates(daily, 30)).orderBy("segment", "ds").toPandas()
    a = out[out.segment == "a"]
    assert np.mean(np.abs(a.yhat.to_numpy() - y[700:]) / y[700:]) < 0.03
    assert (out.yhat_lower < out.yhat).all() and (out.yhat < out.yhat_upper).all()
    assert np.allclose(out.yhat, out.trend * out.yearly * out.weekly * out.holidays)


def test_prediction_expression_equals_the_design_matrix(series_of):
    values = weekly_series(200)
    daily = series_of({"s": values})
    for options in (seasonal.SeasonalOptions(), seasonal.SeasonalOptions(multiplicative=False, yearly=False)):
        fitted = seasonal.fit(daily, options=options)
        row = fitted.first()
        inside = seasonal.predict(fitted, daily).orderBy("ds").toPandas()
        target = np.log(values) if options.multiplicative else values
        got = np.log(inside.yhat) if options.multiplicative else inside.yhat
        assert np.sqrt(np.mean((target - got.to_numpy()) ** 2)) == pytest.approx(row["sigma"], rel=1e-6)


def test_additive_when_values_are_not_positive(series_of):
    assert seasonal.fit(series_of({"s": [-1, 2, 3, 4, 5, 6]})).first()["multiplicative"] is False


def test_tiny_series_still_fit(series_of):
    for values in ([5], [5, 6], [5, 5, 5]):
        daily = series_of({"s": values})
        out = seasonal.predict(seasonal.fit(daily), baseline.future_dates(daily, 3)).collect()
        assert len(out) == 3 and all(math.isfinite(r["yhat"]) for r in out)


def test_holidays(spark, series_of):
    y = np.full(120, 100.0)
    y[::30] = 150
    daily = series_of({"s": y})
    holidays = daily.filter((F.dayofyear("ds") - 1) % 30 == 0).select("ds", F.lit("billing").alias("holiday"))
    options = seasonal.SeasonalOptions(yearly=False, weekly=False)
    fitted = seasonal.fit(daily, options=options, holidays=holidays)
    out = seasonal.predict(fitted, daily, holidays=holidays).toPandas().sort_values("ds")
    assert out.holidays.iloc[0] == pytest.approx(1.5, rel=0.02) and out.holidays.iloc[1] == 1


def test_components_of_a_plain_forecast_are_null(series_of):
    daily = series_of({"s": [1]})
    assert seasonal.components(baseline.naive(daily, 1)).first()["trend"] is None


def test_cross_validation(series_of):
    daily = series_of({"s": weekly_series(300), "short": [1, 2, 3]})
    out = {r["segment"]: r for r in seasonal.cross_validate(daily, 180, 30, 30).collect()}
    assert out["s"]["folds"] == 3 and out["s"]["mape"] < 10 and 0 <= out["s"]["coverage"] <= 1
    assert out["short"]["folds"] == 0 and math.isnan(out["short"]["rmse"])


def test_options_are_checked():
    with pytest.raises(ValueError):
        seasonal.SeasonalOptions(changepoint_prior_scale=0)
    with pytest.raises(ValueError):
        arima.ArimaOptions(criterion="guess")
    with pytest.raises(ValueError):
        boosted.BoostedOptions(learning_rate=0)


# ---- unit roots and ARIMA ----


def test_adf_and_kpss():
    own = np.random.default_rng(17)
    noises = [own.normal(0, 1, 300) for _ in range(30)]
    walks = [np.cumsum(x) for x in noises]
    share = lambda test: sum(map(test, range(30)))
    assert share(lambda i: stationarity.adf(noises[i])[1] < 0.01) == 30
    assert share(lambda i: stationarity.adf(walks[i])[1] < 0.05) <= 5
    assert share(lambda i: stationarity.kpss(noises[i])[1] > 0.05) >= 25
    # The automatic bandwidth finds about four of five random walks.
    assert share(lambda i: stationarity.kpss(walks[i])[1] <= 0.05) >= 20
    assert stationarity.adf_pvalue(-2.86) == pytest.approx(0.05, abs=0.002)
    assert stationarity.adf_pvalue(-3.43) == pytest.approx(0.01, abs=0.001)
    assert math.isnan(stationarity.adf(np.ones(50))[0])


def test_kpss_statistic_by_definition():
    y = np.random.default_rng(4).normal(0, 1, 80).cumsum()
    e, n = y - y.mean(), len(y)
    gamma = lambda k: sum(e[t] * e[t - k] for t in range(k, n)) / n
    first = int(n ** (2 / 9))
    ratio = sum(2 * k * gamma(k) for k in range(1, first + 1)) / (gamma(0) + sum(2 * gamma(k) for k in range(1, first + 1)))
    lags = int(1.1447 * (ratio**2) ** (1 / 3) * n ** (1 / 3))
    spread = gamma(0) + 2 * sum((1 - k / (lags + 1)) * gamma(k) for k in range(1, lags + 1))
    expected = sum(e[: t + 1].sum() ** 2 for t in range(n)) / n**2 / spread
    assert stationarity.kpss(y)[0] == pytest.approx(expected, rel=1e-9)


def test_adf_statistic_without_lags():
    """Against the textbook regression of the change on the level."""
    y = np.random.default_rng(8).normal(0, 1, 60)
    change, x = np.diff(y), np.column_stack([y[:-1], np.ones(59)])
    beta = np.linalg.solve(x.T @ x, x.T @ change)
    sigma2 = np.sum((change - x @ beta) ** 2) / 57
    expected = beta[0] / math.sqrt(sigma2 * np.linalg.inv(x.T @ x)[0, 0])
    assert stationarity.adf(y)[0] == pytest.approx(expected, rel=1e-9)


def test_stationarity_frame(series_of):
    own = np.random.default_rng(2)
    daily = series_of({"noise": own.normal(0, 1, 300), "walk": np.cumsum(own.normal(0, 1, 300)), "flat": [1] * 30})
    out = {r["segment"]: r for r in stationarity.test_stationarity(daily).collect()}
    assert out["noise"]["adf_is_stationary"] is True and out["walk"]["adf_is_stationary"] is False
    assert out["flat"]["adf_pvalue"] is None
    made = stationarity.make_stationary(daily)
    orders = {r["segment"]: (r["d"], r["n"]) for r in made.groupBy("segment", "d").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert orders["noise"] == (0, 300) and orders["walk"] == (1, 299)


def test_shapiro_published_example():
    # Weights of eleven men, the example of the 1965 paper: W = 0.79.
    w, p = stationarity.shapiro_wilk(np.array([148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236.0]))
    assert w == pytest.approx(0.79, abs=0.005) and p < 0.01
    assert stationarity.shapiro_wilk(RNG.normal(0, 1, 500))[1] > 0.01
    assert stationarity.shapiro_wilk(RNG.exponential(1, 500))[1] < 1e-6
    assert 0 <= stationarity.shapiro_wilk(np.array([1.0, 2.0, 4.0]))[1] <= 1
    assert math.isnan(stationarity.shapiro_wilk(np.ones(10))[0])


def test_diagnosis_has_one_row_per_segment(series_of):
    residuals = series_of({"a": RNG.normal(0, 1, 100), "b": RNG.normal(0, 1, 100)}).withColumnRenamed("y", "residual")
    out = stationarity.diagnose_residuals(residuals).collect()
    assert len(out) == 2 and all(r["shapiro_pvalue"] is not None and r["ljung_box_pvalue"] is not None for r in out)


def ar1(n=600, phi=0.7):
    x = [0.0]
    for e in RNG.normal(0, 1, n):
        x.append(phi * x[-1] + e)
    return 50 + np.array(x)


def test_arima_finds_an_autoregression(series_of):
    y = ar1()
    models = arima.fit(series_of({"s": y}), options=arima.ArimaOptions(seasonal=False, max_p=2, max_q=1))
    row = models.first()
    assert row["d"] == 0 and row["p"] >= 1 and row["sigma"] == pytest.approx(1, abs=0.15)
    out = arima.predict(models, 40).toPandas()
    assert out.yhat.iloc[-1] == pytest.approx(y.mean(), abs=1.5)
    width = (out.yhat_upper - out.yhat_lower).to_numpy()
    assert (np.diff(width) >= -1e-9).all()
    assert width[-1] == pytest.approx(2 * 1.96 / math.sqrt(1 - 0.49), rel=0.25)


def test_arima_integrates_a_trend(series_of):
    y = np.cumsum(RNG.normal(1, 0.2, 300))
    models = arima.fit(series_of({"s": y}), options=arima.ArimaOptions(seasonal=False, max_p=1, max_q=0))
    assert models.first()["d"] >= 1
    out = arima.predict(models, 10).orderBy("ds").toPandas()
    assert out.yhat.iloc[-1] - y[-1] == pytest.approx(10, abs=3)
    assert out.ds.iloc[0] == D(2024, 1, 1) + dt.timedelta(days=300)


def test_arima_batches_do_not_change_the_choice(series_of):
    daily = series_of({"s": ar1(200)})
    options = arima.ArimaOptions(max_p=2, max_q=1, seasonal_period=7)
    a, b = (arima.fit(daily, options=options, batches=k).first() for k in (1, 5))
    assert (a["p"], a["q"], a["seasonal_p"]) == (b["p"], b["q"], b["seasonal_p"])


def test_arima_short_and_seasonally_differenced(series_of):
    out = arima.predict(arima.fit(series_of({"s": [3, 4, 5, 4]})), 3).collect()
    assert len(out) == 3 and all(math.isfinite(r["yhat"]) for r in out)
    t = np.arange(210)
    daily = series_of({"s": 100 + 30 * (t % 7 == 0) + RNG.normal(0, 0.5, 210)})
    options = arima.ArimaOptions(max_p=1, max_q=0, seasonal_period=7, seasonal_d=1)
    got = [r["yhat"] for r in arima.predict(arima.fit(daily, options=options), 7).orderBy("ds").collect()]
    assert got[0] == pytest.approx(130, abs=4) and got[3] == pytest.approx(100, abs=4)
    with pytest.raises(ValueError):
        arima.predict(arima.fit(daily, options=options), 0)


# ---- boosted trees ----


@pytest.fixture(scope="module")
def fitted(series_of):
    daily = series_of({"a": weekly_series(240), "b": 3 * weekly_series(240)}).cache()
    options = boosted.BoostedOptions(n_estimators=15, max_depth=4)
    return daily, options, boosted.fit(daily, options)


def test_boosted_beats_the_mean(fitted):
    daily, options, model = fitted
    test = boosted.labelled_rows(daily, options).filter(F.col("split") == "test")
    out = boosted.predict(model, test).join(daily, ["segment", "ds"]).toPandas()
    assert len(out) == 2 * 48
    for _, part in out.groupby("segment"):
        assert np.mean((part.yhat - part.y) ** 2) < np.var(part.y) * 1.5


def test_boosted_aligns_features(fitted):
    daily, options, model = fitted
    rows = boosted.feature_rows(daily).drop("y_lag_30").withColumn("extra", F.lit(1))
    assert boosted.predict(model, rows).count() == 480


def test_importance_sums_to_one(spark, fitted):
    _, _, model = fitted
    rows = boosted.feature_importance(model, spark).collect()
    assert sum(r["importance"] for r in rows) == pytest.approx(1)
    assert [r["importance"] for r in rows] == sorted((r["importance"] for r in rows), reverse=True)
    assert boosted.feature_importance(model, spark, 3).count() == 3


def test_search_and_curve(spark, fitted):
    daily, options, model = fitted
    small = boosted.BoostedOptions(n_estimators=3, max_depth=2)
    best, results = boosted.grid_search(daily, {"max_depth": [1, 3]}, small)
    assert best.max_depth in (1, 3) and len(results) == 2
    curve = boosted.learning_curve(model, boosted.labelled_rows(daily, options), spark).orderBy("trees").collect()
    assert curve[-1]["train_error"] <= curve[0]["train_error"]


def test_direct_forecast_needs_no_recursion(fitted):
    daily, _, _ = fitted
    out = boosted.direct_forecast(daily, 14, boosted.BoostedOptions(n_estimators=5, max_depth=3))
    rows = out.toPandas()
    assert len(rows) == 28 and rows.yhat.notna().all()
    assert rows.ds.min() == D(2024, 1, 1) + dt.timedelta(days=240)


def test_saved_model_loads(spark, fitted, tmp_path):
    daily, _, model = fitted
    path = str(tmp_path / "boosted")
    model.save(path)
    loaded = boosted.BoostedModel.load(spark, path)
    rows = boosted.feature_rows(daily)
    want = {(r["segment"], r["ds"]): r["yhat"] for r in boosted.predict(model, rows).collect()}
    got = {(r["segment"], r["ds"]): r["yhat"] for r in boosted.predict(loaded, rows).collect()}
    assert len(got) == 480 and got == want


def test_boosted_takes_many_segments(spark):
    daily = spark.range(5000).selectExpr("CAST(id AS string) AS segment", "id", "explode(sequence(0, 23)) AS k").selectExpr(
        "segment", "date_add(DATE'2024-01-01', k) AS ds", "CAST(id % 50 + k AS double) AS y"
    )
    model = boosted.fit(daily, boosted.BoostedOptions(n_estimators=3, max_depth=3, validation=0.0))
    out = boosted.predict(model, boosted.feature_rows(daily).filter("ds = DATE'2024-01-24'"))
    assert out.select("segment").distinct().count() == 5000


def test_two_holidays_on_one_day(spark, series_of):
    values = [10.0 + 5.0 * (i % 10 == 0) + 3.0 * (i % 15 == 0) for i in range(120)]
    daily = series_of({"s": values})
    names = daily.selectExpr("ds", "datediff(ds, DATE'2024-01-01') AS i")
    holidays = names.filter("i % 10 = 0").selectExpr("ds", "'A' AS holiday").unionByName(names.filter("i % 15 = 0").selectExpr("ds", "'B' AS holiday"))
    options = seasonal.SeasonalOptions(yearly=False, weekly=False, multiplicative=False, changepoints=0)
    fitted = seasonal.fit(daily, options=options, holidays=holidays)
    effects = fitted.first()["holidays"]
    assert effects["A"] == pytest.approx(5, rel=0.05) and effects["B"] == pytest.approx(3, rel=0.05)
    first = seasonal.predict(fitted, daily, holidays=holidays).orderBy("ds").first()
    assert first["yhat"] == pytest.approx(18, rel=0.02)


def test_arima_order_does_not_depend_on_batches(spark):
    import numpy as np

    rng, rows = np.random.default_rng(4), []
    for s in range(50):
        a, b, y, e0 = rng.uniform(-0.7, 0.7), rng.uniform(-0.7, 0.7), 0.0, 0.0
        for i in range(60 if s % 5 == 0 else 200):
            e = rng.normal()
            y, e0 = a * y + e + b * e0, e
            rows.append((f"s{s}", D(2023, 1, 1) + dt.timedelta(days=i), 50 + y))
    daily = spark.createDataFrame(rows, "segment string, ds date, y double").cache()
    options = arima.ArimaOptions(max_p=2, max_q=2, max_order=3)
    seen = [
        {r["segment"]: (r["p"], r["q"], r["seasonal_p"], r["seasonal_q"], r["fallback"]) for r in arima.fit(daily, options=options, batches=n).collect()}
        for n in (1, 3, 8)
    ]
    assert seen[0] == seen[1] == seen[2] and len(seen[0]) == 50


@pytest.mark.parametrize(
    "make",
    [
        lambda: arima.ArimaOptions(max_p=11),
        lambda: arima.ArimaOptions(max_d=6),
        lambda: arima.ArimaOptions(seasonal_period=0),
        lambda: boosted.BoostedOptions(max_depth=21),
        lambda: boosted.BoostedOptions(n_estimators=0),
        lambda: boosted.BoostedOptions(subsample=1.1),
        lambda: seasonal.SeasonalOptions(holidays_prior_scale=0),
        lambda: seasonal.SeasonalOptions(interval_width=1.0),
    ],
)
def test_option_bounds(make):
    with pytest.raises(ValueError):
        make()


def test_workers_do_not_need_the_package(tmp_path):
    """A session started elsewhere, whose workers cannot import the package."""
    import pathlib
    import subprocess
    import sys

    root = pathlib.Path(__file__).resolve().parents[1]
    script = tmp_path / "elsewhere.py"
    script.write_text(
        f"""
import sys
sys.path.insert(0, {str(root)!r})
from pyspark.sql import SparkSession, functions as F
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
from costlens.models import arima, seasonal, stationarity
from costlens.functions.probability import chi2_sf
daily = spark.range(60).select(F.lit("s").alias("segment"), F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("ds"), (F.rand(1) + 1).alias("y"))
assert seasonal.fit(daily).count() == 1
assert stationarity.test_stationarity(daily).count() == 1
assert arima.predict(arima.fit(daily, options=arima.ArimaOptions(max_p=1, max_q=0, seasonal=False)), 2).count() == 2
assert spark.range(1).select(chi2_sf(F.lit(1.0), F.lit(1.0))).first()[0] > 0
print("done")
"""
    )
    out = subprocess.run([sys.executable, str(script)], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert out.stdout.strip().endswith("done"), out.stderr[-2000:]


def test_forecast_queries_use_declared_defaults(monkeypatch):
    from costlens.models import boosted, seasonal
    from costlens.workload import forecasts

    assert forecasts.OPTIONS == boosted.BoostedOptions()
    given = []
    monkeypatch.setattr(forecasts, "series_frame", lambda *a: "series")
    monkeypatch.setattr(forecasts, "cost_records", lambda *a: "records")
    monkeypatch.setattr(seasonal, "cross_validate", lambda *a, **k: given.append((a, k)))
    monkeypatch.setattr(forecasts.arima, "fit", lambda *a, **k: given.append((a, k)))
    monkeypatch.setattr(forecasts.arima, "predict", lambda *a, **k: None)
    monkeypatch.setattr(forecasts, "train", lambda *a, **k: given.append((a, k)) or type("R", (), {"daily": 0, "best": 1}))
    monkeypatch.setattr(forecasts, "forecast", lambda *a, **k: given.append((a, k)))
    for run in (forecasts.m7, forecasts.m9, forecasts.m16_best):
        run(None, None)
    as_of = forecasts.AS_OF
    assert given == [(("series",), {}), (("series",), {}), (("records", as_of), {}), ((0, 1, as_of), {})]
