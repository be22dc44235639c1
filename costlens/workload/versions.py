"""Model versions and stages derived from the part and event tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from costlens.models import seasonal
from costlens.operators import versions as v
from costlens.plans import forecast_stored, register_best, train
from costlens.session import scratch_path
from costlens.sources import cost_records
from costlens.workload.base import AS_OF, COST, query, sig7, sig7_sql, table
from costlens.workload.evaluation import series_frame
from costlens.workload.monitoring import _utc


def versions(spark, sf):
    """A brand is a model, a part is one of its versions."""
    return table(spark, sf, "part").select(
        F.col("p_brand").alias("name"),
        F.col("p_partkey").cast("string").alias("version"),
        F.col("p_type").alias("model_type"),
        F.lit("Total").alias("category"),
        F.create_map(F.lit("mape"), F.col("p_retailprice")).alias("metrics"),
        F.timestamp_seconds(F.col("p_partkey") * 3600).alias("created_at"),
    )


def events(spark, sf):
    """An order line is a stage event of its part; the flag is the stage."""
    lines = table(spark, sf, "lineitem")
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    stage = (
        F.when(flag == "A", "Archived")
        .when(flag == "N", "Production")
        .when(status == "O", "Staging")
        .otherwise("None")
    )
    parts = table(spark, sf, "part").select(F.col("p_partkey"), F.col("p_brand").alias("name"))
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        "name",
        F.col("l_partkey").cast("string").alias("version"),
        stage.alias("stage"),
        F.col("l_shipdate").cast("timestamp").alias("at"),
    )


VIEW = """ev AS (SELECT p_brand AS name, CAST(l_partkey AS VARCHAR) AS version, CASE WHEN l_returnflag = 'A' THEN 'Archived'
    WHEN l_returnflag = 'N' THEN 'Production' WHEN l_linestatus = 'O' THEN 'Staging' ELSE 'None' END AS stage, l_shipdate AS "at"
  FROM lineitem JOIN part ON l_partkey = p_partkey),
st AS (SELECT name, version, stage, "at" AS since FROM ev
  QUALIFY ROW_NUMBER() OVER (PARTITION BY name, version ORDER BY "at" DESC, stage DESC) = 1),
ver AS (SELECT p_brand AS name, CAST(p_partkey AS VARCHAR) AS version, p_type AS model_type,
  make_timestamp(p_partkey * 3600 * 1000000) AS created_at, p_retailprice FROM part),
vw AS (SELECT ver.*, COALESCE(stage, 'None') AS stage, since FROM ver LEFT JOIN st USING (name, version))"""


def view(spark, sf):
    return v.version_view(versions(spark, sf), events(spark, sf))


@query("v2_current_stages", f"WITH {VIEW} SELECT name, version, stage, since FROM st")
def v2(spark, sf):
    return _utc(v.current_stages(events(spark, sf)))


@query(
    "v4_model_versions",
    f"WITH {VIEW} SELECT name, version, model_type, stage, created_at FROM vw WHERE name = 'Brand#2'",
)
def v4(spark, sf):
    out = v.model_versions(versions(spark, sf), events(spark, sf), "Brand#2")
    return _utc(out.select("name", "version", "model_type", "stage", "created_at"))


_LATEST = "CAST(MAX(CAST(version AS INT)) AS VARCHAR) AS version FROM vw"


@query("w11_latest_by_stage", f"WITH {VIEW} SELECT name, stage, {_LATEST} GROUP BY 1, 2")
def w11(spark, sf):
    return v.latest_versions(view(spark, sf))


@query("v5_latest_production", f"WITH {VIEW} SELECT name, stage, {_LATEST} WHERE stage = 'Production' GROUP BY 1, 2")
def v5(spark, sf):
    return v.latest_versions(view(spark, sf), v.PRODUCTION)


@query(
    "w17_retained_versions",
    f"""WITH {VIEW}, n AS (SELECT name, version, stage, ROW_NUMBER() OVER (PARTITION BY name, stage ORDER BY CAST(version AS INT) DESC) AS i FROM vw)
SELECT name, version, stage FROM n WHERE stage IN ('Production', 'Archived') OR (stage = 'Staging' AND i <= 5) OR (stage = 'None' AND i <= 10)""",
)
def w17(spark, sf):
    return v.retained_versions(view(spark, sf)).select("name", "version", "stage")


@query(
    "v6_version_tags",
    """SELECT p_partkey, 'Total' AS category, CAST(CAST(p_retailprice AS DECIMAL(10,1)) AS VARCHAR) AS mape, 'N/A' AS r2,
  '2001-11-05' AS training_date FROM part""",
)
def v6(spark, sf):
    frame = table(spark, sf, "part").select(
        "p_partkey",
        F.lit("Total").alias("category"),
        F.create_map(F.lit("mape"), F.round("p_retailprice", 1)).alias("metrics"),
        F.lit("2001-11-05").alias("training_date"),
        F.lit("1").alias("data_version"),
    )
    tags = v.version_tags(frame).select("p_partkey", "tags")
    return tags.select("p_partkey", *[F.col("tags")[k].alias(k) for k in ("category", "mape", "r2", "training_date")])



@query(
    "v7_compare_versions",
    f"""WITH {VIEW}, k AS (SELECT CAST(MIN(CAST(version AS INT)) AS VARCHAR) AS a, CAST(MAX(CAST(version AS INT)) AS VARCHAR) AS b
  FROM vw WHERE name = 'Brand#3')
SELECT x.name, x.version AS version1, x.stage AS stage1, x.created_at AS created_at1, y.version AS version2,
  y.stage AS stage2, y.created_at AS created_at2 FROM vw x JOIN k ON x.version = k.a JOIN vw y ON y.version = k.b
WHERE x.name = 'Brand#3' AND y.name = 'Brand#3'""",
)
def v7(spark, sf):
    mine = versions(spark, sf).filter(F.col("name") == "Brand#3")
    number = F.col("version").cast("int")
    ends = mine.agg(F.min(number).alias("a"), F.max(number).alias("b")).first()
    return _utc(v.compare_versions(view(spark, sf), "Brand#3", str(ends["a"]), str(ends["b"])))


@query(
    "j4_version_self_join",
    f"""WITH {VIEW} SELECT p.name, p.version AS production_version, s.version AS staging_version
FROM (SELECT name, {_LATEST} WHERE stage = 'Production' GROUP BY 1) p
JOIN (SELECT name, {_LATEST} WHERE stage = 'Staging' GROUP BY 1) s USING (name)""",
)
def j4(spark, sf):
    latest = v.latest_versions(view(spark, sf))
    pick = lambda stage, name: latest.filter(F.col("stage") == stage).select("name", F.col("version").alias(name))
    return pick("Production", "production_version").join(pick("Staging", "staging_version"), "name")


@query(
    "v8_rollback",
    f"""WITH {VIEW}, t AS (SELECT CAST(MIN(CAST(version AS INT)) AS VARCHAR) AS version FROM vw WHERE name = 'Brand#4'),
c AS (SELECT version FROM vw WHERE name = 'Brand#4' AND stage = 'Production')
SELECT 'Brand#4' AS name, version, 'Archived' AS stage, TIMESTAMP '2001-11-08' AS "at" FROM c
WHERE version IS NOT NULL AND version <> (SELECT version FROM t)
UNION ALL SELECT 'Brand#4', version, 'Production', TIMESTAMP '2001-11-08' FROM t""",
)
def v8(spark, sf):
    mine = versions(spark, sf).filter(F.col("name") == "Brand#4")
    target = str(mine.agg(F.min(F.col("version").cast("int"))).first()[0])
    return _utc(v.rollback_events(view(spark, sf), "Brand#4", target, "2001-11-08 00:00:00"))


@query("v1_register_and_load")
def v1(spark, sf):
    """Fit, store the coefficients, register, promote, and load the production
    model's coefficients back."""
    root = scratch_path(spark, "registry")
    tables = v.VersionTables(spark, root)
    coefficients = seasonal.fit(series_frame(spark, sf))
    for number, at in enumerate(("2001-11-05 00:00:00", "2001-11-06 00:00:00"), 1):
        path = f"{root}/models/seasonal-{number}"
        coefficients.write.parquet(path)
        version = tables.register("seasonal", "seasonal", {"mape": 10.0 - number}, path, at)
        tables.promote("seasonal", version, v.STAGING, at)
    tables.promote("seasonal", "1", v.PRODUCTION, "2001-11-07 00:00:00")
    tables.promote("seasonal", "2", v.PRODUCTION, "2001-11-08 00:00:00")
    tables.rollback("seasonal", "1", "2001-11-09 00:00:00")
    return spark.read.parquet(tables.path_of("seasonal"))


# The training run in SQL: gapless series of the total and of every category, 85 of 100
# days known, three baselines over the rest, the smallest error chooses, and the chosen
# one forecasts from the last day.
TRAINED = f"""{COST}, d0 AS (
  SELECT 'Total' AS segment, usage_date AS ds, SUM(cost_in_billing_currency) AS y FROM cost GROUP BY 2
  UNION ALL SELECT COALESCE(meter_category, 'Unknown'), usage_date, SUM(cost_in_billing_currency) FROM cost GROUP BY 1, 2
), spine AS (SELECT segment, CAST(unnest(generate_series(MIN(ds), MAX(ds), INTERVAL 1 DAY)) AS DATE) AS ds FROM d0 GROUP BY segment
), dense AS MATERIALIZED (
  SELECT segment, ds, COALESCE(y, 0) AS y, (ds - DATE '1970-01-01')::DOUBLE AS x,
    ROW_NUMBER() OVER (PARTITION BY segment ORDER BY ds) AS i, COUNT(*) OVER (PARTITION BY segment) AS n
  FROM spine LEFT JOIN d0 USING (segment, ds)
), cut AS (SELECT *, i <= floor(n * 0.7::DOUBLE) + floor(n * 0.15::DOUBLE) AS known FROM dense
), past AS (SELECT segment, FALSE AS final, ds, x, y FROM cut WHERE known UNION ALL SELECT segment, TRUE, ds, x, y FROM cut
), fits AS MATERIALIZED (
  SELECT segment, final, MAX(ds) AS last, arg_max(y, ds) AS level, regr_slope(y, x) AS a, regr_intercept(y, x) AS b FROM past GROUP BY 1, 2
), ahead AS (
  SELECT f.*, CAST(last + CAST(s AS INT) AS DATE) AS ds, s AS step FROM fits f, (SELECT unnest(range(1, 1001)) AS s)
), told AS (
  SELECT segment, final, ds, step, 'naive' AS model, level AS yhat FROM ahead
  UNION ALL SELECT segment, final, ds, step, 'linear_trend', b + a * (ds - DATE '1970-01-01') FROM ahead
  UNION ALL SELECT h.segment, h.final, h.ds, step, 'seasonal_naive', d.y FROM ahead h
    LEFT JOIN dense d ON d.segment = h.segment AND d.ds = CAST(h.ds - CAST(ceil(step / 7.0) * 7 AS INT) AS DATE)
), errors AS (
  SELECT t.segment, model, AVG(ABS((c.y - yhat) / (c.y + 1e-8))) * 100 AS mape
  FROM told t JOIN cut c ON c.segment = t.segment AND c.ds = t.ds AND NOT c.known WHERE NOT t.final AND yhat IS NOT NULL GROUP BY 1, 2
), best AS (SELECT segment, arg_min(model, struct_pack(m := mape, n := model)) AS model FROM errors GROUP BY 1)"""


def _trained(spark, sf):
    return train(cost_records(spark, sf), AS_OF, models=("naive", "seasonal_naive", "linear_trend"))


@query(
    "v3_production_forecasts",
    f"""WITH {TRAINED} SELECT t.segment, t.model, t.ds, {sig7_sql("yhat")} AS yhat, CAST(h AS INT) AS horizon_days
FROM told t JOIN best b ON b.segment = t.segment AND b.model = t.model, (SELECT unnest([30, 90]) AS h) WHERE final AND step <= h""",
)
def v3(spark, sf):
    """Train, register the best model of every segment, promote, load, forecast."""
    tables = v.VersionTables(spark, scratch_path(spark, "registry"))
    version = register_best(_trained(spark, sf), tables, "2001-11-08 00:00:00", horizons=(30, 90))
    tables.promote_all(version, v.PRODUCTION, "2001-11-08 01:00:00")
    out = forecast_stored(tables, AS_OF, horizons=(30, 90))
    return sig7(out.select("segment", "model", "ds", "yhat", "horizon_days"), "yhat")


@query(
    "v1_registered_models",
    f"""WITH {TRAINED} SELECT 'cost/' || b.segment AS name, version, b.model AS model_type, b.segment AS category,
  CASE WHEN version = '2' THEN 'Production' ELSE 'Archived' END AS stage, {sig7_sql("mape")} AS mape,
  CAST(last AS VARCHAR) AS training_date, '2001-11-08 00:00:00' AS tagged_at
FROM best b JOIN errors e ON e.segment = b.segment AND e.model = b.model JOIN fits f ON f.segment = b.segment AND final, (SELECT unnest(['1', '2']) AS version)""",
)
def v1_registered(spark, sf):
    """Two training runs registered and promoted in turn: the registry afterwards."""
    tables = v.VersionTables(spark, scratch_path(spark, "registry"))
    result = _trained(spark, sf)
    for hour in (1, 2):
        version = register_best(result, tables, "2001-11-08 00:00:00", horizons=(30,))
        tables.promote_all(version, v.PRODUCTION, f"2001-11-08 0{hour}:00:00")
    return sig7(
        tables.view().select(
            "name", "version", "model_type", "category", "stage", F.col("metrics")["mape"].alias("mape"),
            F.col("tags")["training_date"].alias("training_date"), F.col("tags")["created_at"].alias("tagged_at"),
        ),
        "mape",
    )
