from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from costlens.models import baseline, boosted, intervals


def ranked(errors, width):
    errors = sorted(errors)
    return errors[min(math.ceil((len(errors) + 1) * width), len(errors)) - 1]


def test_radius_is_the_ranked_error(spark):
    rng = np.random.default_rng(4)
    sizes = {"one": 1, "few": 7, "some": 100, "many": 3000}
    rows = [(name, float(e)) for name, n in sizes.items() for e in rng.exponential(1.0, n)]
    frame = spark.createDataFrame(rows, "segment string, error double").repartition(5)
    for width in (0.5, 0.8, 0.95):
        got = {r["segment"]: (r["n"], r["radius"]) for r in intervals.conformal_radius(frame, ["segment"], width).collect()}
        assert got == {name: (n, ranked([e for s, e in rows if s == name], width)) for name, n in sizes.items()}


@pytest.mark.parametrize("model, forecast", [("naive", baseline.naive), ("seasonal_naive", baseline.seasonal_naive), ("linear_trend", baseline.linear_trend)])
def test_rolling_errors_are_those_of_forecasts_from_each_day(series_of, model, forecast):
    rng = np.random.default_rng(5)
    values = (100 + rng.normal(0, 5, 40)).tolist()
    daily = series_of({"a": values, "b": [3.0, 4.0]})
    got = {(r["segment"], r["ds"], r["step"]): r["error"] for r in intervals.rolling_errors(daily, model, (1, 8)).collect()}
    first = dt.date(2024, 1, 1)
    for origin in (13, 20, 30):
        past = series_of({"a": values[: origin + 1]})
        told = {r["ds"]: r["yhat"] for r in forecast(past, 8).collect()}
        for step in (1, 8):
            day = first + dt.timedelta(days=origin + step)
            assert got[("a", day, step)] == pytest.approx(abs(values[origin + step] - told[day]), abs=1e-9)
    assert all(s != "b" or step == 1 for s, _, step in got)


def test_gaps_and_unknown_values_give_no_errors(spark):
    day = lambda i: dt.date(2024, 1, 1) + dt.timedelta(days=i)
    rows = [("a", day(0), 1.0), ("a", day(1), 2.0), ("a", day(3), 4.0), ("a", day(4), None), ("a", day(5), float("nan")), ("a", day(6), 9.0)]
    daily = spark.createDataFrame(rows, "segment string, ds date, y double")
    assert [(r["ds"], r["error"]) for r in intervals.rolling_errors(daily, "naive", (1,)).collect()] == [(day(1), 1.0)]
    assert intervals.radii(daily, "naive", 0.9).first()["radii"] == [(1, 1.0)]


def test_bounds_of_every_step(spark, series_of):
    state = spark.createDataFrame([("a", dt.date(2024, 1, 1), [(1, 2.0), (4, 6.0)]), ("b", dt.date(2024, 1, 1), None)], "segment string, last date, radii array<struct<step:int,radius:double>>")
    days = [(s, dt.date(2024, 1, 1 + i), 10.0) for s in "ab" for i in (1, 2, 4, 16)]
    out = intervals.with_bounds(spark.createDataFrame(days, "segment string, ds date, yhat double"), state)
    reach = {(r["segment"], r["ds"].day - 1): r["yhat_upper"] - r["yhat"] for r in out.collect()}
    assert reach == {("a", 1): 2.0, ("a", 2): 6.0, ("a", 4): 6.0, ("a", 16): 12.0, **{("b", i): math.inf for i in (1, 2, 4, 16)}}


def test_a_random_walk_is_covered(series_of):
    """Intervals from the first 600 days hold about as many of the later days as they say."""
    rng = np.random.default_rng(6)
    daily = series_of({f"s{i}": np.cumsum(rng.normal(0, 1, 900)).tolist() for i in range(6)})
    errors = intervals.rolling_errors(daily, "naive", (1, 7))
    cut = F.col("ds") <= F.date_add(F.lit(dt.date(2024, 1, 1)), 599)
    radius = intervals.conformal_radius(errors.filter(cut), ["segment", "step"], 0.9)
    scored = errors.filter(~cut).join(radius, ["segment", "step"]).groupBy("step").agg(F.avg((F.col("error") <= F.col("radius")).cast("double")).alias("c"))
    assert all(abs(r["c"] - 0.9) < 0.05 for r in scored.collect())


def test_boosted_bounds(series_of):
    rng = np.random.default_rng(7)
    daily = series_of({s: (50 + 10 * np.sin(np.arange(200) * 2 * np.pi / 7) + rng.normal(0, n, 200)).tolist() for s, n in (("calm", 0.5), ("wild", 5.0))})
    options = boosted.BoostedOptions(n_estimators=8, max_depth=3)
    out = boosted.project(boosted.fit_direct(daily, 7, options)).collect()
    width = {r["segment"]: r["yhat_upper"] - r["yhat_lower"] for r in out}
    assert len(out) == 14 and 0 < width["calm"] < width["wild"] < 100
    none = boosted.project(boosted.fit_direct(daily, 7, boosted.BoostedOptions(n_estimators=2, max_depth=2, calibration=0.0))).first()
    assert none["yhat_upper"] == math.inf and none["yhat_lower"] == -math.inf
