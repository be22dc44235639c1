"""Unit-root and normality tests on daily series, one group per segment.

Each group is one bounded daily series; numpy does the small regressions.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ALPHA = 0.05
_NORMAL = NormalDist()

# Response surface of the p-value of the Dickey-Fuller statistic
# with a constant (MacKinnon 1994), below and above the turning point.
ADF_TURN, ADF_LOW, ADF_HIGH = -1.61, -18.83, 2.74
ADF_SMALL = (2.1659, 1.4412, 0.038269)
ADF_LARGE = (1.7339, 0.93202, -0.12745, -0.010368)
# Critical points of the KPSS statistic around a level.
KPSS_POINTS = (0.347, 0.463, 0.574, 0.739)
KPSS_PVALUES = (0.10, 0.05, 0.025, 0.01)


def adf(y: np.ndarray) -> tuple[float, float]:
    """Augmented Dickey-Fuller statistic and p-value, constant, lag by AIC."""
    n = len(y)
    if n < 8 or np.ptp(y) == 0:
        return math.nan, math.nan
    most = max(0, min(math.ceil(12 * (n / 100) ** 0.25), n // 2 - 2))
    change = np.diff(y)

    def regress(lags: int, start: int):
        rows = np.arange(start, len(change))
        columns = [y[rows], np.ones(len(rows))] + [change[rows - k] for k in range(1, lags + 1)]
        x, target = np.column_stack(columns), change[rows]
        beta, *_ = np.linalg.lstsq(x, target, rcond=None)
        return x, target, beta, float(np.sum((target - x @ beta) ** 2))

    def aic(lags: int) -> float:
        x, _, _, sse = regress(lags, most)
        return len(x) * math.log(max(sse, 1e-300) / len(x)) + 2 * x.shape[1]

    lags = min(range(most + 1), key=aic)
    x, _, beta, sse = regress(lags, lags)
    freedom = len(x) - x.shape[1]
    if freedom <= 0:
        return math.nan, math.nan
    variance = sse / freedom * np.linalg.pinv(x.T @ x)[0, 0]
    if variance <= 0:
        return math.nan, math.nan
    statistic = float(beta[0] / math.sqrt(variance))
    return statistic, adf_pvalue(statistic)


def adf_pvalue(statistic: float) -> float:
    if statistic <= ADF_LOW:
        return 0.0
    if statistic >= ADF_HIGH:
        return 1.0
    powers = ADF_SMALL if statistic <= ADF_TURN else ADF_LARGE
    return _NORMAL.cdf(sum(c * statistic**i for i, c in enumerate(powers)))


def kpss(y: np.ndarray) -> tuple[float, float]:
    """KPSS statistic around a constant and its clipped p-value."""
    n = len(y)
    if n < 8 or np.ptp(y) == 0:
        return math.nan, math.nan
    e = y - y.mean()
    pair = lambda k: float(np.dot(e[k:], e[: n - k]))
    s0, s1 = pair(0) / n, 0.0
    for k in range(1, int(n ** (2 / 9)) + 1):
        weight = 2 * pair(k) / n
        s0 += weight
        s1 += k * weight
    lags = min(int(1.1447 * ((s1 / s0) ** 2) ** (1 / 3) * n ** (1 / 3)), n - 1)
    spread = pair(0) + 2 * sum(pair(k) * (1 - k / (lags + 1)) for k in range(1, lags + 1))
    statistic = float(np.sum(np.cumsum(e) ** 2) / (n * spread))
    return statistic, float(np.interp(statistic, KPSS_POINTS, KPSS_PVALUES))


def shapiro_wilk(values: np.ndarray) -> tuple[float, float]:
    """W and p-value by Royston's approximation (1995), 3 to 5000 values."""
    x = np.sort(values)
    n = len(x)
    if n < 3 or n > 5000 or np.ptp(x) == 0:
        return math.nan, math.nan
    m = np.array([_NORMAL.inv_cdf((i - 0.375) / (n + 0.25)) for i in range(1, n + 1)])
    total = float(m @ m)
    u = 1 / math.sqrt(n)
    # The published polynomials.
    last = np.polyval([-2.706056, 4.434685, -2.071190, -0.147981, 0.221157, m[-1] / math.sqrt(total)], u)
    weights = np.empty(n)
    if n == 3:
        weights[:] = [-math.sqrt(0.5), 0.0, math.sqrt(0.5)]
    elif n <= 5:
        phi = (total - 2 * m[-1] ** 2) / (1 - 2 * last**2)
        weights[:] = m / math.sqrt(phi)
        weights[0], weights[-1] = -last, last
    else:
        second = np.polyval([-3.582633, 5.682633, -1.752461, -0.293762, 0.042981, m[-2] / math.sqrt(total)], u)
        phi = (total - 2 * m[-1] ** 2 - 2 * m[-2] ** 2) / (1 - 2 * last**2 - 2 * second**2)
        weights[:] = m / math.sqrt(phi)
        weights[0], weights[1], weights[-2], weights[-1] = -last, -second, second, last
    w = min(float((weights @ x) ** 2 / np.sum((x - x.mean()) ** 2)), 1.0)
    if n == 3:
        return w, max(0.0, min(1.0, 6 / math.pi * (math.asin(math.sqrt(w)) - math.asin(math.sqrt(0.75)))))
    if w >= 1:
        return w, 1.0
    if n <= 11:
        bound = -2.273 + 0.459 * n
        if math.log(1 - w) >= bound:
            return w, 0.0
        score = -math.log(bound - math.log(1 - w))
        mean = np.polyval([-0.0006714, 0.025054, -0.39978, 0.5440], n)
        spread = math.exp(np.polyval([-0.0020322, 0.062767, -0.77857, 1.3822], n))
    else:
        score = math.log(1 - w)
        mean = np.polyval([0.0038915, -0.083751, -0.31082, -1.5861], math.log(n))
        spread = math.exp(np.polyval([0.0030302, -0.082676, -0.4803], math.log(n)))
    return w, 1 - _NORMAL.cdf((score - mean) / spread)


def _known(daily: DataFrame, value_col: str, keys: Sequence[str], date_col: str) -> DataFrame:
    value = F.col(value_col).cast("double")
    return daily.filter(value.isNotNull() & ~F.isnan(value)).select(
        *keys, F.col(date_col).alias("ds"), value.alias("y")
    )


def _key_types(frame: DataFrame, keys: Sequence[str]) -> str:
    types = {f.name: f.dataType.simpleString() for f in frame.schema}
    return ", ".join(f"{k} {types[k]}" for k in keys)


def test_stationarity(
    daily: DataFrame, value_col: str = "y", keys: Sequence[str] = ("segment",), date_col: str = "ds"
) -> DataFrame:
    """ADF and KPSS p-values and verdicts per segment; a test that cannot be
    computed gives null."""
    frame, names = _known(daily, value_col, keys, date_col), list(keys)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        y = pdf.sort_values("ds")["y"].to_numpy(float)
        a, ap = adf(y)
        k, kp = kpss(y)
        row = {name: pdf[name].iloc[0] for name in names}
        row |= {"adf_statistic": a, "adf_pvalue": ap, "kpss_statistic": k, "kpss_pvalue": kp}
        return pd.DataFrame([row])

    schema = f"{_key_types(frame, names)}, adf_statistic double, adf_pvalue double, kpss_statistic double, kpss_pvalue double"
    tested = frame.groupBy(*names).applyInPandas(run, schema)
    return tested.withColumns(
        {
            "adf_is_stationary": F.col("adf_pvalue") < ALPHA,
            "kpss_is_stationary": F.col("kpss_pvalue") > ALPHA,
        }
    )


test_stationarity.__test__ = False


def integration_order(y: np.ndarray, max_diff: int) -> int:
    """Differences needed until the ADF test rejects a unit root."""
    for d in range(max_diff):
        _, p = adf(y)
        if math.isnan(p) or p < ALPHA:
            return d
        y = np.diff(y)
    return max_diff


def make_stationary(
    daily: DataFrame, max_diff: int = 3, value_col: str = "y", keys: Sequence[str] = ("segment",), date_col: str = "ds"
) -> DataFrame:
    """``keys, ds, y_diff, d``: the series differenced until stationary."""
    frame, names = _known(daily, value_col, keys, date_col), list(keys)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ds")
        y = pdf["y"].to_numpy(float)
        d = integration_order(y, max_diff)
        out = pdf.iloc[d:][[*names, "ds"]].copy()
        out["y_diff"] = np.diff(y, n=d)
        out["d"] = d
        return out

    return frame.groupBy(*names).applyInPandas(run, f"{_key_types(frame, names)}, ds date, y_diff double, d int")


def shapiro(
    residuals: DataFrame, value_col: str = "residual", keys: Sequence[str] = ("segment",), date_col: str = "ds"
) -> DataFrame:
    """Shapiro-Wilk statistic, p-value and verdict per segment; longer series
    than the method covers give null (see ``jarque_bera``)."""
    frame, names = _known(residuals, value_col, keys, date_col), list(keys)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        w, p = shapiro_wilk(pdf["y"].to_numpy(float))
        return pd.DataFrame([{name: pdf[name].iloc[0] for name in names} | {"shapiro_statistic": w, "shapiro_pvalue": p}])

    tested = frame.groupBy(*names).applyInPandas(
        run, f"{_key_types(frame, names)}, shapiro_statistic double, shapiro_pvalue double"
    )
    return tested.withColumn("shapiro_is_normal", F.col("shapiro_pvalue") > ALPHA)


def diagnose_residuals(
    residuals: DataFrame, value_col: str = "residual", keys: Sequence[str] = ("segment",), date_col: str = "ds"
) -> DataFrame:
    """Moments, Ljung-Box and Shapiro-Wilk of every segment in one row."""
    from costlens.operators.residuals import ljung_box, residual_moments

    box = ljung_box(residuals, 10, value_col, keys, date_col).select(
        *keys,
        F.col("statistic").alias("ljung_box_statistic"),
        F.col("pvalue").alias("ljung_box_pvalue"),
        F.col("is_white_noise").alias("ljung_box_is_white_noise"),
    )
    moments = residual_moments(residuals, value_col, keys)
    return moments.join(box, list(keys), "left").join(shapiro(residuals, value_col, keys, date_col), list(keys), "left")
