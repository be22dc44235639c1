"""Registry, base frames and the matching SQL building blocks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from costlens.operators.aggregate import daily_costs
from costlens.sources import cost_records

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

AS_OF = "2001-11-08 00:00:00"


def query(name: str, sql: str | None = None):
    """Register a query and, where it exists, its oracle."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def r(column, digits: int = 4) -> Column:
    """Rounded output column under its own name."""
    name = column if isinstance(column, str) else None
    out = F.round(F.nanvl(F.col(name) if name else column, F.lit(None).cast("double")), digits)
    return out.alias(name) if name else out


def rounded(df: DataFrame, digits: int = 4, *columns: str) -> DataFrame:
    """Round double columns (all, or the named ones); NaN becomes null."""
    names = columns or [f.name for f in df.schema if f.dataType.simpleString() == "double"]
    return df.withColumns({c: r(F.col(c), digits) for c in names})


def sig7(df: DataFrame, *columns: str) -> DataFrame:
    """Seven significant digits, for means whose exact value may lie half-way
    between two rounded decimals."""
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast("double")).cast("float").cast("double") for c in columns})


def sig7_sql(expression: str) -> str:
    return f"CAST(CAST({expression} AS FLOAT) AS DOUBLE)"


# ---- base frames ----------------------------------------------------------

SERIES_COLUMNS = ["usage_date", "cost_in_billing_currency", "quantity", "effective_price"]


def daily_by(spark: SparkSession, sf: str, key: str = "meter_category") -> DataFrame:
    """``segment, ds, y, total_quantity, avg_rate``, one row per day and key."""
    records = cost_records(spark, sf, [*SERIES_COLUMNS, key])
    return daily_costs(records, [key]).select(
        F.col(key).alias("segment"),
        F.col("usage_date").alias("ds"),
        F.round("daily_cost", 4).alias("y"),
        "total_quantity",
        "avg_rate",
    )


def daily_total(spark: SparkSession, sf: str) -> DataFrame:
    """The same for the total; reads no dimension table."""
    return daily_costs(cost_records(spark, sf, SERIES_COLUMNS)).select(
        F.lit("Total").alias("segment"),
        F.col("usage_date").alias("ds"),
        F.round("daily_cost", 4).alias("y"),
        "total_quantity",
        "avg_rate",
    )


def order_series(spark: SparkSession, sf: str) -> DataFrame:
    """Daily order value by priority: a series with missing days."""
    return (
        table(spark, sf, "orders")
        .groupBy(F.col("o_orderpriority").alias("segment"), F.to_date("o_orderdate").alias("ds"))
        .agg(F.round(F.sum("o_totalprice"), 2).alias("y"))
    )


# ---- the same in SQL ------------------------------------------------------

COST = """cost AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS subscription_id, l_linenumber AS line_number,
    CAST(l_shipdate AS DATE) AS usage_date, p_type AS meter_category, p_brand AS meter_sub_category,
    p_name AS consumed_service, n_name AS resource_location, l_returnflag AS plan_name,
    l_quantity AS quantity, l_extendedprice / l_quantity AS effective_price,
    l_extendedprice * (1 - l_discount) AS cost_in_billing_currency,
    CAST(l_suppkey AS VARCHAR) AS resource_id, CAST(l_partkey AS VARCHAR) AS meter_id,
    CASE WHEN l_linestatus = 'O' THEN 'USD' ELSE 'EUR' END AS billing_currency_code
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
    LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey
)"""


def daily_sql(key: str = "meter_category", name: str = "series") -> str:
    segment = "'Total'" if key == "Total" else key
    return f"""{name} AS (
  SELECT {segment} AS segment, usage_date AS ds, ROUND(SUM(cost_in_billing_currency), 4) AS y,
    SUM(quantity) AS total_quantity, AVG(effective_price) AS avg_rate
  FROM cost GROUP BY 1, 2
)"""


SERIES = f"{COST}, {daily_sql()}"
TOTAL = f"{COST}, {daily_sql('Total')}"

ORDERS = """series AS (
  SELECT o_orderpriority AS segment, CAST(o_orderdate AS DATE) AS ds, ROUND(SUM(o_totalprice), 2) AS y
  FROM orders GROUP BY 1, 2
)"""

DAYS = "PARTITION BY segment ORDER BY ds"
