from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from costlens.models.arima import ArimaOptions
from costlens.models.boosted import BoostedOptions
from costlens.plans import forecast, segment_series, train

AS_OF = "2025-01-15 00:00:00"


@pytest.fixture(scope="module")
def records(spark):
    """Two categories in two regions; one category has a strong weekly cycle."""
    rng = np.random.default_rng(9)
    import datetime as dt

    rows = []
    for i in range(380):
        day = dt.date(2024, 1, 1) + dt.timedelta(days=i)
        for category, base in (("Compute", 500), ("Storage", 90)):
            for region in ("east", "west"):
                cost = base + 0.2 * i + (base / 5) * math.sin(2 * math.pi * i / 7) + rng.normal(0, base / 100)
                rows.append((day, category, region, "USD", cost, 2.0, cost / 2, f"{i}-{category}-{region}"))
    schema = (
        "usage_date date, meter_category string, resource_location string, billing_currency_code string, "
        "cost_in_billing_currency double, quantity double, effective_price double, resource_id string"
    )
    return spark.createDataFrame(rows, schema).cache()


@pytest.fixture(scope="module")
def result(records):
    return train(
        records,
        AS_OF,
        arima_options=ArimaOptions(max_p=2, max_q=1, seasonal_period=7),
        boosted_options=BoostedOptions(n_estimators=8, max_depth=3),
    )


def test_training_compares_all_models(result):
    rows = result.comparison.collect()
    assert {r["segment"] for r in rows} == {"Total", "Compute", "Storage"}
    assert {r["model"] for r in rows} == {"naive", "seasonal_naive", "linear_trend", "seasonal", "arima", "boosted"}
    assert not result.failures
    n = {r["n"] for r in rows}
    assert n == {380 - int(380 * 0.7) - int(380 * 0.15)}
    assert result.quality.first()["quality_score"] == pytest.approx(100)


def test_the_cycle_is_learnt(result):
    best = {r["segment"]: r for r in result.best.collect()}
    assert len(best) == 3 and all(r["mape"] < 10 for r in best.values())
    assert all(r["model"] not in ("naive", "linear_trend") for r in best.values())


def test_forecasts_of_the_best_models(result):
    out = forecast(result.daily, result.best, AS_OF, (7, 30))
    counted = {(r["segment"], r["horizon_days"]): r["count"] for r in out.groupBy("segment", "horizon_days").count().collect()}
    assert counted == {(s, h): h for s in ("Total", "Compute", "Storage") for h in (7, 30)}
    assert out.filter("yhat is null").count() == 0
    assert out.filter("not is_preliminary").count() == out.count()


def test_levels_get_distinct_names(records):
    names = {r["segment"] for r in segment_series(records, ("region", "category_region")).select("segment").distinct().collect()}
    assert names == {"region:east", "region:west"} | {f"{c}|{r}" for c in ("Compute", "Storage") for r in ("east", "west")}


def test_a_failing_model_does_not_end_the_run(records, monkeypatch):
    def broken(*args, **kwargs):
        raise RuntimeError("no trees today")

    monkeypatch.setattr("costlens.plans.training.boosted.fit", broken)
    out = train(records, AS_OF, models=("naive", "boosted"))
    assert out.failures == {"boosted": "no trees today"}
    assert {r["model"] for r in out.comparison.collect()} == {"naive"}


def test_arguments(records):
    with pytest.raises(ValueError):
        train(records, AS_OF, models=("oracle",))
    with pytest.raises(ValueError):
        train(records.limit(0), AS_OF)


def test_a_failing_model_ends_alone(spark, records, monkeypatch):
    from costlens.models import seasonal
    from costlens.plans import train

    def broken(pdf, options):
        raise ValueError("no fit")

    monkeypatch.setattr(seasonal, "_solve", broken)
    result = train(records, as_of="2024-12-31 00:00:00", models=("naive", "seasonal", "linear_trend"))
    assert set(result.failures) == {"seasonal"}
    assert {r["model"] for r in result.comparison.select("model").distinct().collect()} == {"naive", "linear_trend"}


@pytest.mark.parametrize("kind", ["naive", "seasonal_naive", "linear_trend", "seasonal", "arima", "boosted"])
def test_a_loaded_model_forecasts_what_the_fitted_one_does(spark, result, tmp_path, kind):
    from costlens.models import stored

    fitted = stored.fit(kind, result.daily, (7, 30), result.options)
    fitted.save(spark, str(tmp_path / "model"))
    loaded = stored.FittedModel.load(spark, str(tmp_path / "model"))
    rows = lambda model: sorted(map(tuple, model.forecast((7, 30)).collect()))
    got = rows(loaded)
    assert got == rows(fitted) and len(got) == 3 * 37
    one = loaded.only(result.daily.filter("segment = 'Total'").select("segment").distinct())
    assert sorted(map(tuple, one.forecast((7, 30)).collect())) == [r for r in got if r[0] == "Total"]


def test_registered_models_forecast_without_a_fit(spark, result, tmp_path, monkeypatch):
    from costlens.models import stored
    from costlens.operators.versions import PRODUCTION, STAGING, VersionTables
    from costlens.plans import forecast_stored, register_best

    tables = VersionTables(spark, str(tmp_path / "registry"))
    version = register_best(result, tables, AS_OF, horizons=(7, 30))
    with pytest.raises(ValueError):
        forecast_stored(tables, AS_OF, horizons=(7, 30))
    tables.promote_all(version, PRODUCTION, AS_OF)
    wanted = sorted(map(tuple, forecast(result.daily, result.best, AS_OF, (7, 30), options=result.options).collect()))

    def never(*args, **kwargs):
        raise AssertionError("fitted again")

    monkeypatch.setattr(stored, "fit", never)
    assert sorted(map(tuple, forecast_stored(tables, AS_OF, horizons=(7, 30)).collect())) == wanted
    row = tables.models_in().filter("category = 'Total'").first()
    best = {r["segment"]: r for r in result.best.collect()}["Total"]
    assert (row["name"], row["model_type"], row["tags"]["created_at"]) == ("cost/Total", best["model"], AS_OF)
    assert row["metrics"]["mape"] == pytest.approx(best["mape"])
    tables.promote_all(version, STAGING, "2025-01-16 00:00:00")
    assert forecast_stored(tables, AS_OF, STAGING, (7,)).count() == 21


def test_rows_without_a_day_are_reported(spark, records):
    from costlens.plans.training import undated_rows

    lost = records.limit(3).withColumn("usage_date", F.lit(None).cast("date"))
    row = undated_rows(records.unionByName(lost)).first()
    assert row["rows"] == 3 and row["cost"] > 0
    assert tuple(undated_rows(records).first()) == (0, 0.0)
