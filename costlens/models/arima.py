"""ARIMA forecasts for every segment in parallel.

Orders are chosen by an information criterion over candidates that are spread
over groups; each candidate is estimated by the two-stage regression of Hannan
and Rissanen (1982). A group holds one bounded daily series. The fitted row
carries the coefficients and the last values, so prediction never reads the
history again.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlens.functions.checks import within
from costlens.models.stationarity import integration_order

MODEL = (
    "p int, d int, q int, seasonal_p int, seasonal_d int, seasonal_q int, score double, constant double, "
    "ar array<double>, ma array<double>, sigma double, last_ds date, y_tail array<double>, e_tail array<double>, n long, "
    "fallback boolean"
)


@dataclass(frozen=True)
class ArimaOptions:
    seasonal: bool = True
    seasonal_period: int = 12
    max_p: int = 5
    max_d: int = 2
    max_q: int = 5
    max_order: int = 5
    seasonal_d: int = 0
    criterion: str = "aic"
    # Days on which candidates are scored, at least; deeper candidates drop out.
    minimum_days: int = 20

    def __post_init__(self):
        if self.criterion not in ("aic", "bic"):
            raise ValueError("criterion must be aic or bic")
        within("max_p", self.max_p, 0, 10)
        within("max_q", self.max_q, 0, 10)
        within("max_d", self.max_d, 0, 5)
        within("seasonal_d", self.seasonal_d, 0, 2)
        within("seasonal_period", self.seasonal_period, 1)


def candidate_orders(options: ArimaOptions) -> list[tuple[int, int, int, int]]:
    """(p, q, P, Q) up to the limits, simplest first."""
    seasons = (0, 1) if options.seasonal and options.seasonal_period > 1 else (0,)
    orders = [
        (p, q, sp, sq)
        for p in range(options.max_p + 1)
        for q in range(options.max_q + 1)
        for sp in seasons
        for sq in seasons
        if p + q + sp + sq <= options.max_order
    ]
    return sorted(orders, key=lambda o: (sum(o), o))


def _lagged(values: np.ndarray, lags: Sequence[int], start: int) -> np.ndarray:
    return np.column_stack([values[start - k : len(values) - k] for k in lags]) if lags else np.empty((len(values) - start, 0))


def _estimate(w: np.ndarray, shocks: np.ndarray, order, m: int, start: int, criterion: str):
    """Second-stage regression on own lags and estimated shocks."""
    p, q, sp, sq = order
    ar_lags = sorted({*range(1, p + 1), *(m * k for k in range(1, sp + 1))})
    ma_lags = sorted({*range(1, q + 1), *(m * k for k in range(1, sq + 1))})
    target = w[start:]
    x = np.hstack([np.ones((len(target), 1)), _lagged(w, ar_lags, start), _lagged(shocks, ma_lags, start)])
    beta, *_ = np.linalg.lstsq(x, target, rcond=None)
    error = target - x @ beta
    sse = float(error @ error)
    n, k = len(target), x.shape[1] + 1
    penalty = 2 * k if criterion == "aic" else k * math.log(n)
    score = n * math.log(max(sse, 1e-300) / n) + penalty
    ar = np.zeros(max(ar_lags, default=0))
    ma = np.zeros(max(ma_lags, default=0))
    for lag, value in zip(ar_lags, beta[1:]):
        ar[lag - 1] = value
    for lag, value in zip(ma_lags, beta[1 + len(ar_lags) :]):
        ma[lag - 1] = value
    stable = _inside(ar) and _inside(-ma)
    return (score if stable else math.inf), float(beta[0]), ar, ma, math.sqrt(sse / max(n - k + 1, 1)), error


def _inside(coefficients: np.ndarray) -> bool:
    """All roots of the lag polynomial ``1 - sum(c_k B^k)`` lie outside the
    unit circle."""
    if not coefficients.any():
        return True
    return bool(np.all(np.abs(np.roots(np.r_[1.0, -coefficients])) < 0.9999))


def _with_differences(ar: np.ndarray, d: int, seasonal_d: int, m: int) -> np.ndarray:
    """Autoregression on the level: the stationary part times the differences."""
    poly = np.r_[1.0, -ar]
    for _ in range(d):
        poly = np.convolve(poly, [1.0, -1.0])
    seasonal = np.zeros(m + 1)
    seasonal[0], seasonal[-1] = 1.0, -1.0
    for _ in range(seasonal_d):
        poly = np.convolve(poly, seasonal)
    return -poly[1:]


def _depth(order, m: int) -> int:
    return max(order[0], order[1], m * order[2], m * order[3])


def _fit_series(pdf: pd.DataFrame, orders, options: ArimaOptions, depths: Sequence[int]) -> dict:
    """``depths`` are the longest lags of all candidates, deepest first, not of
    these orders alone: every candidate is scored on the same days, however they
    are dealt. ``fallback`` tells that the series was too short for the deepest."""
    pdf = pdf.sort_values("ds")
    y = pdf["y"].to_numpy(float)
    m = options.seasonal_period
    seasonal_d = options.seasonal_d if len(y) > 3 * m else 0
    w = y
    for _ in range(seasonal_d):
        w = w[m:] - w[:-m]
    d = integration_order(w, options.max_d)
    w = np.diff(w, n=d)
    for deepest in depths:
        long_order = min(max(2 * deepest, 10), len(w) // 4) if deepest else 0
        start = long_order + deepest
        if len(w) - start >= options.minimum_days:
            break
    short = deepest < depths[0]
    orders = [o for o in orders if _depth(o, m) <= deepest] or [(0, 0, 0, 0)]
    shocks = np.zeros_like(w)
    if long_order:
        x = np.hstack([np.ones((len(w) - long_order, 1)), _lagged(w, range(1, long_order + 1), long_order)])
        beta, *_ = np.linalg.lstsq(x, w[long_order:], rcond=None)
        shocks[long_order:] = w[long_order:] - x @ beta
    fits = [(order, _estimate(w, shocks, order, m, start, options.criterion)) for order in orders]
    order, (score, constant, ar, ma, sigma, error) = min(fits, key=lambda f: f[1][0])
    level = _with_differences(ar, d, seasonal_d, m)
    # The tail pads with zeros when the series is shorter than the lags.
    tail = lambda v, k: np.r_[np.zeros(max(k - len(v), 0)), v[len(v) - min(k, len(v)) :]].tolist()
    return {
        "p": order[0], "d": d, "q": order[1],
        "seasonal_p": order[2], "seasonal_d": seasonal_d, "seasonal_q": order[3],
        "score": score, "constant": constant, "ar": level.tolist(), "ma": ma.tolist(), "sigma": sigma,
        "last_ds": pd.Timestamp(pdf["ds"].iloc[-1]).date(),
        "y_tail": tail(y, len(level)), "e_tail": tail(error, len(ma)), "n": len(y), "fallback": bool(short),
    }


def fit(
    history: DataFrame,
    keys: Sequence[str] = ("segment",),
    options: ArimaOptions = ArimaOptions(),
    batches: int = 4,
) -> DataFrame:
    """One model row per key. The candidate orders are dealt to ``batches``
    groups per key, and the best of each group meets in an aggregate."""
    names = list(keys)
    known = history.filter(F.col("y").isNotNull() & ~F.isnan("y")).select(*names, "ds", F.col("y").cast("double").alias("y"))
    orders = candidate_orders(options)
    batches = max(1, min(batches, len(orders)))
    m = options.seasonal_period
    depths = sorted({0, *(_depth(o, m) for o in orders)}, reverse=True)
    spread = known.withColumn("_batch", F.explode(F.sequence(F.lit(0), F.lit(batches - 1))))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        chosen = orders[int(pdf["_batch"].iloc[0]) :: batches]
        return pd.DataFrame([{name: pdf[name].iloc[0] for name in names} | _fit_series(pdf, chosen, options, depths)])

    types = {f.name: f.dataType.simpleString() for f in known.schema}
    schema = ", ".join(f"{name} {types[name]}" for name in names) + ", " + MODEL
    fitted = spread.groupBy(*names, "_batch").applyInPandas(run, schema)
    rest = [c for c in fitted.columns if c not in names]
    ranking = F.struct("score", "p", "q", "seasonal_p", "seasonal_q")
    return fitted.groupBy(*names).agg(F.min_by(F.struct(*rest), ranking).alias("_best")).select(*names, "_best.*")


def predict(models: DataFrame, periods: int, keys: Sequence[str] = ("segment",), confidence: float = 0.95) -> DataFrame:
    """``keys, ds, yhat, yhat_lower, yhat_upper`` for the days after the fit."""
    if periods < 1:
        raise ValueError("periods must be at least one")
    names = list(keys)
    z = NormalDist().inv_cdf(0.5 + confidence / 2)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            frames = [_project(row, periods, z, names) for row in pdf.to_dict("records")]
            yield pd.concat(frames) if frames else pd.DataFrame(columns=[*names, "ds", "yhat", "yhat_lower", "yhat_upper"])

    types = {f.name: f.dataType.simpleString() for f in models.schema}
    schema = ", ".join(f"{name} {types[name]}" for name in names) + ", ds date, yhat double, yhat_lower double, yhat_upper double"
    return models.mapInPandas(run, schema)


def _project(row: dict, periods: int, z: float, names: Sequence[str]) -> pd.DataFrame:
    ar, ma = np.asarray(row["ar"], float), np.asarray(row["ma"], float)
    y, e = list(row["y_tail"]), list(row["e_tail"])
    mean, psi = [], [1.0]
    for step in range(periods):
        recent_y = np.asarray(y[len(y) - len(ar) :][::-1], float)
        recent_e = np.asarray(e[len(e) - len(ma) :][::-1], float)
        value = row["constant"] + float(ar @ recent_y) + float(ma @ recent_e)
        mean.append(value)
        y.append(value)
        e.append(0.0)
        k = step + 1
        weight = ma[k - 1] if k <= len(ma) else 0.0
        psi.append(weight + sum(ar[j] * psi[k - 1 - j] for j in range(min(len(ar), k))))
    reach = z * row["sigma"] * np.sqrt(np.cumsum(np.square(psi[:periods])))
    days = pd.date_range(pd.Timestamp(row["last_ds"]) + pd.Timedelta(days=1), periods=periods)
    out = pd.DataFrame({"ds": days.date, "yhat": mean})
    out["yhat_lower"], out["yhat_upper"] = out["yhat"] - reach, out["yhat"] + reach
    for name in names:
        out[name] = row[name]
    return out[[*names, "ds", "yhat", "yhat_lower", "yhat_upper"]]
