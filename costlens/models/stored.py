"""One interface for all forecasting models: fit, store, load, forecast.

A fitted model holds all its segments and needs no history to forecast, so a stored one
forecasts exactly what the fitted one would have.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costlens.models import arima, baseline, boosted, intervals, seasonal
from costlens.session import materialise

MODELS = ("naive", "seasonal_naive", "linear_trend", "seasonal", "arima", "boosted")
SEGMENT = ("segment",)


@dataclass(frozen=True)
class ModelOptions:
    """Options of all kinds of models; the defaults are the declared ones."""

    season: int = 7
    width: float = 0.95  # of the intervals, but for the seasonal model's own
    seasonal: seasonal.SeasonalOptions = seasonal.SeasonalOptions()
    arima: arima.ArimaOptions = arima.ArimaOptions()
    boosted: boosted.BoostedOptions = boosted.BoostedOptions()


@dataclass
class FittedModel:
    """A fitted model of one kind: one row per segment in ``state``, or for the boosted
    kind one direct model per horizon in ``direct``. ``width`` is that of the intervals."""

    kind: str
    state: DataFrame | None = None
    direct: Mapping[int, boosted.BoostedModel] = field(default_factory=dict)
    width: float = 0.8

    def save(self, spark: SparkSession, path: str) -> None:
        horizons = sorted(self.direct)
        if self.state is not None:
            self.state.write.parquet(f"{path}/state")
        for horizon in horizons:
            self.direct[horizon].save(f"{path}/direct-{horizon}")
        # Written last: a model without it is not whole.
        row = spark.createDataFrame([(self.kind, self.width, horizons)], "kind string, width double, horizons array<int>")
        row.coalesce(1).write.parquet(f"{path}/model")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FittedModel:
        row = spark.read.parquet(f"{path}/model").first()
        direct = {h: boosted.BoostedModel.load(spark, f"{path}/direct-{h}") for h in row["horizons"]}
        state = None if direct else spark.read.parquet(f"{path}/state")
        return cls(row["kind"], state, direct, row["width"])

    def only(self, segments: DataFrame) -> FittedModel:
        """The same model for some of its segments (``segment``, distinct)."""
        keep = lambda df: df.join(segments, "segment", "left_semi")
        direct = {h: boosted.BoostedModel(m.trees, m.features, m.statistics, m.horizon, keep(m.tail), m.radius) for h, m in self.direct.items()}
        return FittedModel(self.kind, None if self.state is None else keep(self.state), direct, self.width)

    def forecast(self, horizons: Sequence[int]) -> DataFrame:
        """``segment, ds, yhat, yhat_lower, yhat_upper, horizon_days`` of the days after
        the history. Seasonal and ARIMA models have intervals of their own, the others
        split-conformal ones."""
        if self.direct:
            missing = set(horizons) - set(self.direct)
            if missing:
                raise ValueError(f"the boosted model has no horizon of {sorted(missing)} days, only {sorted(self.direct)}")
            out = None
            for horizon in horizons:
                frame = forecast_columns(boosted.project(self.direct[horizon])).withColumn("horizon_days", F.lit(int(horizon)))
                out = frame if out is None else out.unionByName(frame)
            return out
        frame = forecast_columns(_PROJECT[self.kind](self.state, max(horizons), self.width))
        return baseline.by_horizon(frame, horizons, SEGMENT)


def forecast_columns(frame: DataFrame) -> DataFrame:
    bounds = [F.col(c) if c in frame.columns else F.lit(None).cast("double").alias(c) for c in ("yhat_lower", "yhat_upper")]
    return frame.select("segment", "ds", "yhat", *bounds)


def _fit_seasonal(history: DataFrame, options: ModelOptions) -> DataFrame:
    last = history.groupBy(*SEGMENT).agg(F.max("ds").alias("last"))
    return seasonal.fit(history, options=options.seasonal).join(last, list(SEGMENT))


def _project_seasonal(state: DataFrame, periods: int, width: float) -> DataFrame:
    dates = state.select("segment", F.explode(F.sequence(F.date_add("last", 1), F.date_add("last", periods))).alias("ds"))
    return seasonal.predict(state.drop("last"), dates, interval_width=width)


def _with_radii(kind: str, state: DataFrame, history: DataFrame, options: ModelOptions) -> DataFrame:
    return state.join(intervals.radii(history, kind, options.width, options.season), list(SEGMENT), "left")


_FIT: dict[str, Callable[[DataFrame, ModelOptions], DataFrame]] = {
    "naive": lambda history, options: _with_radii("naive", baseline.fit_naive(history), history, options),
    "seasonal_naive": lambda history, options: _with_radii("seasonal_naive", baseline.fit_seasonal_naive(history, options.season), history, options),
    "linear_trend": lambda history, options: _with_radii("linear_trend", baseline.fit_linear_trend(history), history, options),
    "seasonal": _fit_seasonal,
    "arima": lambda history, options: arima.fit(history, options=options.arima),
}
_PROJECT: dict[str, Callable[[DataFrame, int, float], DataFrame]] = {
    "naive": lambda state, periods, width: intervals.with_bounds(baseline.project_level(state, periods), state),
    "seasonal_naive": lambda state, periods, width: intervals.with_bounds(baseline.project_seasonal_naive(state, periods), state),
    "linear_trend": lambda state, periods, width: intervals.with_bounds(baseline.project_linear_trend(state, periods), state),
    "seasonal": _project_seasonal,
    "arima": lambda state, periods, width: arima.predict(state, periods, confidence=width),
}


def fit(kind: str, history: DataFrame, horizons: Sequence[int], options: ModelOptions = ModelOptions()) -> FittedModel:
    """Fit one kind of model to ``segment, ds, y``. The state is checkpointed: stored and
    fitted model forecast from the same rows.

    Boosted models, one per horizon, are fitted side by side: each is a chain of small
    jobs that leaves most of a cluster idle.
    """
    if kind not in MODELS:
        raise ValueError(f"unknown model: {kind}")
    width = options.seasonal.interval_width if kind == "seasonal" else options.width
    if kind != "boosted":
        return FittedModel(kind, materialise(_FIT[kind](history, options)), {}, width)
    one = lambda horizon: boosted.fit(history, options.boosted, horizon=horizon, width=width)
    distinct = sorted(set(horizons))
    if len(distinct) == 1:
        return FittedModel(kind, None, {distinct[0]: one(distinct[0])}, width)
    with ThreadPoolExecutor(max_workers=min(4, len(distinct))) as pool:
        # Each thread takes its own copy of the session's local properties.
        own = inheritable_thread_target(history.sparkSession)
        running = [pool.submit(own(lambda h=h: one(h))) for h in distinct]
        return FittedModel(kind, None, dict(zip(distinct, (r.result() for r in running))), width)
