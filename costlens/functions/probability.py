"""Tail probabilities as column expressions."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SERIES_TERMS = 100
# Below this the alternating series is numerically one.
KOLMOGOROV_FLOOR = 0.2


def kolmogorov_pvalue(d: Column, n1: Column, n2: Column) -> Column:
    """Asymptotic two-sample Kolmogorov-Smirnov tail probability."""
    lam = d * F.sqrt(n1 * n2 / (n1 + n2).cast("double"))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(SERIES_TERMS)),
        F.lit(0.0),
        lambda acc, k: acc
        + F.when(k % 2 == 1, F.lit(1.0)).otherwise(F.lit(-1.0)) * F.exp(F.lit(-2.0) * k * k * lam * lam),
    )
    return F.when(lam < KOLMOGOROV_FLOOR, F.lit(1.0)).otherwise(
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.lit(2.0) * series))
    )


def chi2_sf_even(q: Column, dof: int) -> Column:
    """Chi-square survival function for an even number of degrees of freedom."""
    if dof % 2:
        raise ValueError("closed form needs an even number of degrees of freedom")
    half = q / F.lit(2.0)
    total = F.lit(1.0)
    for i in range(1, dof // 2):
        total = total + F.pow(half, F.lit(float(i))) / F.lit(float(math.factorial(i)))
    return F.exp(-half) * total


def normal_two_sided(z: Column) -> Column:
    """Two-sided normal tail, by the rational erfc approximation 7.1.26 of
    Abramowitz and Stegun (absolute error below 1.5e-7)."""
    # Fixed values of the published approximation.
    p = 0.3275911
    a = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)
    x = F.abs(z) / F.lit(math.sqrt(2.0))
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(p) * x)
    poly = F.lit(0.0)
    for coefficient in reversed(a):
        poly = (poly + F.lit(coefficient)) * t
    return poly * F.exp(-x * x)


def _upper_gamma(a: float, x: float) -> float:
    """Regularised upper incomplete gamma: series below a+1, continued fraction above."""
    if x <= 0:
        return 1.0
    scale = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1:
        term = total = 1.0 / a
        n = a
        while abs(term) > abs(total) * 1e-15:
            n += 1
            term *= x / n
            total += term
        return 1.0 - total * scale
    b = x + 1 - a
    c, d = 1e300, 1.0 / b
    h = d
    for i in range(1, 500):
        an = -i * (i - a)
        b += 2
        d = 1.0 / (an * d + b)
        c = b + an / c
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return h * scale


@F.pandas_udf(T.DoubleType())
def chi2_sf(q: pd.Series, dof: pd.Series) -> pd.Series:
    """Chi-square survival function for any degrees of freedom; meant for
    result frames that hold one row per tested column."""
    return pd.Series(
        [
            float("nan") if pd.isna(x) or pd.isna(k) or k <= 0 else _upper_gamma(k / 2.0, x / 2.0)
            for x, k in zip(np.asarray(q, float), np.asarray(dof, float))
        ],
        dtype="float64",
    )
