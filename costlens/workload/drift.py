"""Distribution drift and residual tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from costlens.models.stationarity import diagnose_residuals, make_stationary, shapiro, test_stationarity
from costlens.operators import drift as d
from costlens.operators.prepare import difference
from costlens.operators.residuals import autocorrelation, jarque_bera, ljung_box
from costlens.workload.base import DAYS, SERIES, daily_by, query, rounded, table

FEATURES = ["l_quantity", "l_extendedprice", "l_discount"]
_LONG = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {c} AS value, (CAST(l_shipdate AS DATE) < DATE '1998-06-01')::INT AS b FROM lineitem"
    for c in FEATURES
)
LONG = f"long AS ({_LONG})"


def halves(spark, sf):
    """Lines shipped before and since the middle of the period."""
    lines = table(spark, sf, "lineitem")
    first = F.to_date("l_shipdate") < F.lit("1998-06-01").cast("date")
    return lines.filter(first), lines.filter(~first)


@query(
    "x1_baseline",
    f"""WITH {LONG} SELECT feature, COUNT(*) AS n, ROUND(AVG(value), 6) AS mean, ROUND(STDDEV_SAMP(value), 6) AS std
FROM long WHERE b = 1 GROUP BY 1""",
)
def x1(spark, sf):
    return rounded(d.describe_baseline(halves(spark, sf)[0], FEATURES), 6)


_KS = f"""{LONG}, t AS (SELECT feature, SUM(b)::DOUBLE AS n1, SUM(1 - b)::DOUBLE AS n2,
    AVG(value) FILTER (b = 1) AS m1, AVG(value) FILTER (b = 0) AS m2, STDDEV_SAMP(value) FILTER (b = 1) AS s1
  FROM long GROUP BY 1),
v AS (SELECT feature, value, SUM(b) AS c1, SUM(1 - b) AS c2 FROM long GROUP BY 1, 2),
c AS (SELECT feature, SUM(c1) OVER w AS k1, SUM(c2) OVER w AS k2 FROM v WINDOW w AS (PARTITION BY feature ORDER BY value)),
k AS (SELECT feature, MAX(ABS(k1 / n1 - k2 / n2)) AS statistic FROM c JOIN t USING (feature) GROUP BY 1),
l AS (SELECT k.feature, statistic, n1, n2, m1, m2, s1, statistic * SQRT(n1 * n2 / (n1 + n2)) AS lam FROM k JOIN t ON k.feature = t.feature),
p AS (SELECT *, CASE WHEN lam < 0.2 THEN 1.0 ELSE GREATEST(0.0, LEAST(1.0, 2 * list_sum(list_transform(range(1, 101),
  lambda k: (CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END) * exp(-2.0 * k * k * lam * lam))))) END AS pvalue FROM l)"""


@query("x2_ks_drift", f"""WITH {_KS} SELECT feature, ROUND(statistic, 10) AS statistic, ROUND(pvalue, 7) AS pvalue,
  pvalue < 0.05 AS is_drift, ROUND(ABS(m2 - m1) / s1, 7) AS drift_magnitude FROM p WHERE feature = 'l_extendedprice'""")
def x2(spark, sf):
    out = d.distribution_drift(*halves(spark, sf), "l_extendedprice")
    out = out.select("feature", "statistic", "pvalue", "is_drift", "drift_magnitude")
    return rounded(rounded(out, 10, "statistic"), 7, "pvalue", "drift_magnitude")


@query("x4_feature_drift", f"""WITH {_KS} SELECT feature, n1::BIGINT AS n_baseline, n2::BIGINT AS n_current,
  ROUND(m1, 6) AS mean_baseline, ROUND(m2, 6) AS mean_current, ROUND(s1, 5) AS std_baseline,
  ROUND(statistic, 10) AS statistic, ROUND(pvalue, 7) AS pvalue, pvalue < 0.05 AS is_drift,
  ROUND(ABS(m2 - m1) / s1, 7) AS drift_magnitude FROM p""")
def x4(spark, sf):
    out = d.ks_drift(*halves(spark, sf), [*FEATURES, "not_there"])
    out = rounded(rounded(out, 10, "statistic"), 7, "pvalue", "drift_magnitude")
    return rounded(rounded(out, 6, "mean_baseline", "mean_current"), 5, "std_baseline")


_LEVELS = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS level, (CAST(l_shipdate AS DATE) < DATE '1998-06-01')::INT AS b FROM lineitem"
    for c in ("l_returnflag", "l_linenumber")
)


@query(
    "x3_chi2_drift",
    f"""WITH lv AS ({_LEVELS}), c AS (SELECT feature, level, SUM(b)::DOUBLE AS b, SUM(1 - b)::DOUBLE AS c FROM lv GROUP BY 1, 2),
t AS (SELECT *, SUM(b) OVER f AS tb, SUM(c) OVER f AS tc, COUNT(*) OVER f - 1 AS dof FROM c WINDOW f AS (PARTITION BY feature))
SELECT feature, dof, ROUND(SUM((b - (b + c) * tb / (tb + tc)) ** 2 / ((b + c) * tb / (tb + tc))
  + (c - (b + c) * tc / (tb + tc)) ** 2 / ((b + c) * tc / (tb + tc))), 6) AS statistic FROM t GROUP BY 1, 2""",
)
def x3(spark, sf):
    out = d.chi2_drift(*halves(spark, sf), ["l_returnflag", "l_linenumber"])
    return rounded(out.select("feature", "dof", "statistic"), 6)


# With two degrees of freedom the tail is exp(-x / 2).
@query(
    "x3_chi2_pvalue",
    f"""WITH lv AS ({_LEVELS}), c AS (SELECT feature, level, SUM(b)::DOUBLE AS b, SUM(1 - b)::DOUBLE AS c FROM lv
  WHERE feature = 'l_returnflag' GROUP BY 1, 2),
t AS (SELECT *, SUM(b) OVER f AS tb, SUM(c) OVER f AS tc, COUNT(*) OVER f - 1 AS dof FROM c WINDOW f AS (PARTITION BY feature)),
x AS (SELECT feature, dof, SUM((b - (b + c) * tb / (tb + tc)) ** 2 / ((b + c) * tb / (tb + tc))
  + (c - (b + c) * tc / (tb + tc)) ** 2 / ((b + c) * tc / (tb + tc))) AS x FROM t GROUP BY 1, 2)
SELECT feature, dof, ROUND(x, 6) AS statistic, ROUND(exp(-x / 2), 8) AS pvalue, exp(-x / 2) < 0.05 AS is_drift FROM x""",
)
def x3_pvalue(spark, sf):
    out = d.distribution_drift(*halves(spark, sf), "l_returnflag", "chi2")
    return rounded(rounded(out, 6, "statistic"), 8, "pvalue")


@query(
    "x5_psi",
    f"""WITH {LONG}, q AS (SELECT feature, quantile_cont(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS cuts
  FROM long WHERE b = 1 GROUP BY 1),
k AS (SELECT feature, len(list_filter(cuts, lambda c: c < value)) AS bucket, SUM(b)::DOUBLE AS b, SUM(1 - b)::DOUBLE AS c
  FROM long JOIN q USING (feature) GROUP BY 1, 2),
s AS (SELECT feature, GREATEST(c / SUM(c) OVER f, 1e-4) AS p, GREATEST(b / SUM(b) OVER f, 1e-4) AS q FROM k
  WINDOW f AS (PARTITION BY feature))
SELECT feature, ROUND(SUM((p - q) * ln(p / q)), 8) AS psi FROM s GROUP BY 1""",
)
def x5(spark, sf):
    return rounded(d.psi(*halves(spark, sf), FEATURES), 8)


@query(
    "x6_mann_whitney",
    f"""WITH {LONG}, v AS (SELECT feature, value, COUNT(*)::DOUBLE AS k, SUM(1 - b)::DOUBLE AS c, SUM(b)::DOUBLE AS b FROM long GROUP BY 1, 2),
r AS (SELECT *, SUM(k) OVER (PARTITION BY feature ORDER BY value) - k + (k + 1) / 2 AS mid FROM v),
s AS (SELECT feature, SUM(b) AS n1, SUM(c) AS n2, SUM(c * mid) AS ranks, SUM(k * k * k - k) AS ties FROM r GROUP BY 1),
z AS (SELECT feature, ranks - n2 * (n2 + 1) / 2 AS u, n1, n2, SQRT(n1 * n2 / 12 * (n1 + n2 + 1 - ties / ((n1 + n2) * (n1 + n2 - 1)))) AS sd FROM s)
SELECT feature, u, ROUND((u - n1 * n2 / 2) / sd, 7) AS z FROM z""",
)
def x6(spark, sf):
    return rounded(d.mann_whitney(*halves(spark, sf), FEATURES).select("feature", "u", "z"), 7, "z")


def _periods(spark, sf):
    daily = daily_by(spark, sf).select("segment", "ds", "y")
    return daily.filter(F.col("ds") < F.lit("1998-06-01").cast("date")), daily.filter(
        F.col("ds") >= F.lit("1998-06-01").cast("date")
    )


@query(
    "x7_season_profile",
    f"""WITH {SERIES}, w AS (SELECT segment, isodow(ds) AS d, COALESCE(SUM(y) FILTER (ds < DATE '1998-06-01'), 0) AS b,
    COALESCE(SUM(y) FILTER (ds >= DATE '1998-06-01'), 0) AS c FROM series GROUP BY 1, 2),
s AS (SELECT segment, GREATEST(c / SUM(c) OVER f, 1e-4) AS p, GREATEST(b / SUM(b) OVER f, 1e-4) AS q FROM w
  WINDOW f AS (PARTITION BY segment))
SELECT segment, ROUND(SUM((p - q) * ln(p / q)), 8) AS psi FROM s GROUP BY 1""",
)
def x7_season(spark, sf):
    return rounded(d.season_profile_shift(*_periods(spark, sf)), 8)


@query(
    "x7_trend_shift",
    f"""WITH {SERIES}, t AS (SELECT segment, regr_slope(y, (ds - DATE '1970-01-01')::DOUBLE) FILTER (ds < DATE '1998-06-01') AS a,
  regr_slope(y, (ds - DATE '1970-01-01')::DOUBLE) FILTER (ds >= DATE '1998-06-01') AS b FROM series GROUP BY 1)
SELECT segment, ROUND(a, 5) AS slope_baseline, ROUND(b, 5) AS slope_current, ROUND(b - a, 5) AS slope_change FROM t""",
)
def x7_trend(spark, sf):
    return rounded(d.trend_shift(*_periods(spark, sf)), 5)


RESIDUALS = f"""{SERIES}, res AS (SELECT * FROM (SELECT segment, ds, y - LAG(y, 7) OVER ({DAYS}) AS r FROM series)
  WHERE r IS NOT NULL), cen AS (SELECT segment, ds, r - AVG(r) OVER (PARTITION BY segment) AS c FROM res),
lag AS (SELECT segment, c, {', '.join(f"LAG(c, {k}) OVER ({DAYS}) AS l{k}" for k in range(1, 11))} FROM cen),
acf AS (SELECT segment, COUNT(*)::DOUBLE AS n, {', '.join(f"SUM(c * l{k}) / SUM(c * c) AS r{k}" for k in range(1, 11))}
  FROM lag GROUP BY 1)"""


def residuals(spark, sf):
    return difference(
        daily_by(spark, sf).select("segment", "ds", "y"), order=0, seasonal_lag=7, out_col="residual"
    ).drop("y")


@query(
    "x10_ljung_box",
    f"""WITH {RESIDUALS}, q AS (SELECT segment, n * (n + 2) * ({' + '.join(f"r{k} * r{k} / (n - {k})" for k in range(1, 11))}) AS q
  FROM acf), p AS (SELECT *, exp(-q / 2) * (1 + q / 2 + (q / 2) ** 2 / 2 + (q / 2) ** 3 / 6 + (q / 2) ** 4 / 24) AS pv FROM q)
SELECT segment, ROUND(q, 5) AS statistic, ROUND(pv, 8) AS pvalue, pv > 0.05 AS is_white_noise FROM p""",
)
def x10(spark, sf):
    out = ljung_box(residuals(spark, sf))
    return rounded(rounded(out, 5, "statistic"), 8, "pvalue")


@query(
    "x11_jarque_bera",
    f"""WITH {RESIDUALS}, m AS (SELECT segment, AVG(c ** 2) AS m2, AVG(c ** 3) AS m3, AVG(c ** 4) AS m4, COUNT(*) AS n FROM cen GROUP BY 1),
j AS (SELECT segment, n, n / 6.0 * ((m3 / m2 ** 1.5) ** 2 + (m4 / m2 ** 2 - 3) ** 2 / 4) AS jb FROM m)
SELECT segment, n, ROUND(jb, 5) AS statistic, ROUND(exp(-jb / 2), 8) AS pvalue, exp(-jb / 2) > 0.05 AS is_normal FROM j""",
)
def x11(spark, sf):
    return rounded(rounded(jarque_bera(residuals(spark, sf)), 5, "statistic"), 8, "pvalue")


@query("x11_shapiro")
def x11_shapiro(spark, sf):
    return shapiro(residuals(spark, sf))


@query("x12_residual_diagnosis")
def x12(spark, sf):
    return diagnose_residuals(residuals(spark, sf))


@query(
    "x13_autocorrelation",
    f"""WITH {RESIDUALS} {' UNION ALL '.join(f"SELECT segment, {k} AS lag, ROUND(r{k}, 8) AS acf, n::BIGINT AS n FROM acf" for k in range(1, 11))}""",
)
def x13(spark, sf):
    return rounded(autocorrelation(residuals(spark, sf)), 8)


@query("x8_stationarity")
def x8(spark, sf):
    return test_stationarity(daily_by(spark, sf))


@query("x9_make_stationary")
def x9(spark, sf):
    return make_stationary(daily_by(spark, sf))
