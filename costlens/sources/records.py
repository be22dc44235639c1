"""Usage-cost records: schema, column mapping, scans and scan filters."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TOTAL = "Total"

# The column names and types of the raw cost table.
RAW_SCHEMA = T.StructType(
    [
        T.StructField("subscription_id", T.StringType()),
        T.StructField("resource_group", T.StringType()),
        T.StructField("resource_location", T.StringType()),
        T.StructField("usage_date", T.DateType()),
        T.StructField("meter_category", T.StringType()),
        T.StructField("meter_sub_category", T.StringType()),
        T.StructField("meter_id", T.StringType()),
        T.StructField("meter_name", T.StringType()),
        T.StructField("meter_region", T.StringType()),
        T.StructField("quantity", T.DoubleType()),
        T.StructField("effective_price", T.DoubleType()),
        T.StructField("cost_in_billing_currency", T.DoubleType()),
        T.StructField("consumed_service", T.StringType()),
        T.StructField("resource_id", T.StringType()),
        T.StructField("tags", T.StringType()),
        T.StructField("offer_id", T.StringType()),
        T.StructField("additional_info", T.StringType()),
        T.StructField("service_info1", T.StringType()),
        T.StructField("service_info2", T.StringType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("plan_name", T.StringType()),
        T.StructField("billing_currency_code", T.StringType()),
        T.StructField("unit_of_measure", T.StringType()),
    ]
)

# Names used by older exports of the same table.
LEGACY_NAMES = {
    "SubscriptionGuid": "subscription_id",
    "ResourceGroup": "resource_group",
    "ResourceLocation": "resource_location",
    "UsageDateTime": "usage_date",
    "MeterCategory": "meter_category",
    "MeterSubCategory": "meter_sub_category",
    "MeterId": "meter_id",
    "MeterName": "meter_name",
    "MeterRegion": "meter_region",
    "UsageQuantity": "quantity",
    "ResourceRate": "effective_price",
    "PreTaxCost": "cost_in_billing_currency",
    "ConsumedService": "consumed_service",
    "InstanceId": "resource_id",
    "Tags": "tags",
    "OfferId": "offer_id",
    "AdditionalInfo": "additional_info",
    "ServiceInfo1": "service_info1",
    "ServiceInfo2": "service_info2",
    "ServiceName": "product_name",
    "ServiceTier": "plan_name",
    "Currency": "billing_currency_code",
    "UnitOfMeasure": "unit_of_measure",
}


def map_attributes(df: DataFrame, mapping: Mapping[str, str] | None = None) -> DataFrame:
    """Rename old column names and cast to the declared types.

    Columns the declared schema does not know are kept as they are.
    """
    names = LEGACY_NAMES if mapping is None else mapping
    types = {field.name: field.dataType for field in RAW_SCHEMA}
    columns = []
    for old in df.columns:
        new = names.get(old, old)
        column = F.col(old)
        if new in types and df.schema[old].dataType != types[new]:
            column = column.cast(types[new])
        columns.append(column.alias(new))
    return df.select(*columns)


def filter_records(
    df: DataFrame,
    start_date: str | None = None,
    end_date: str | None = None,
    category: str | None = None,
    date_col: str = "usage_date",
    category_col: str = "meter_category",
) -> DataFrame:
    """Date bounds inclusive at both ends; ``Total`` means every category."""
    if start_date is not None:
        df = df.filter(F.col(date_col).cast("date") >= F.lit(start_date).cast("date"))
    if end_date is not None:
        df = df.filter(F.col(date_col).cast("date") <= F.lit(end_date).cast("date"))
    if category is not None and category != TOTAL:
        df = df.filter(F.col(category_col) == category)
    return df


def load_records(
    spark: SparkSession,
    source: str,
    start_date: str | None = None,
    end_date: str | None = None,
    category: str | None = None,
    fmt: str | None = None,
    mapping: Mapping[str, str] | None = None,
    date_col: str = "usage_date",
    category_col: str = "meter_category",
) -> DataFrame:
    """Scan a catalog table (``fmt=None``) or a path, with the usual filters."""
    df = spark.read.table(source) if fmt is None else spark.read.format(fmt).load(source)
    if mapping is not None:
        df = map_attributes(df, mapping)
    return filter_records(df, start_date, end_date, category, date_col, category_col)


def read_csv(spark: SparkSession, path: str, schema: T.StructType = RAW_SCHEMA) -> DataFrame:
    """CSV with a header row and a declared schema, so no inference pass."""
    return spark.read.csv(path, header=True, schema=schema, enforceSchema=False)


# Which dimension each derived column of ``cost_records`` needs.
_PART_COLUMNS = {"meter_category", "meter_sub_category", "consumed_service"}
_PLACE_COLUMNS = {"resource_location"}


def cost_records(spark: SparkSession, sf_dir: str, columns: Iterable[str] | None = None) -> DataFrame:
    """The order-line tables seen as usage-cost records.

    Only the dimensions that ``columns`` needs are joined. The joins are outer
    joins on unique keys: a line without a dimension row keeps its cost and gets
    a null category. Spark broadcasts a dimension only while its size stays
    below ``spark.sql.autoBroadcastJoinThreshold``; past that it shuffles and
    adaptive execution splits hot keys.
    """
    wanted = None if columns is None else list(columns)
    need = _PART_COLUMNS | _PLACE_COLUMNS if wanted is None else set(wanted)

    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    if need & _PART_COLUMNS:
        part = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_type", "p_brand", "p_name")
        lines = lines.join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
    if need & _PLACE_COLUMNS:
        nation = spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_nationkey", "n_name")
        supplier = spark.read.parquet(f"{sf_dir}/supplier.parquet").select("s_suppkey", "s_nationkey")
        place = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
        lines = lines.join(place, F.col("l_suppkey") == F.col("s_suppkey"), "left")

    cost = F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount"))
    derived = {
        "subscription_id": F.col("l_orderkey").cast("string"),
        "line_number": F.col("l_linenumber"),
        "usage_date": F.to_date("l_shipdate"),
        "plan_name": F.col("l_returnflag"),
        "quantity": F.col("l_quantity"),
        "effective_price": F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")),
        "cost_in_billing_currency": cost,
        "resource_id": F.col("l_suppkey").cast("string"),
        "meter_id": F.col("l_partkey").cast("string"),
        "billing_currency_code": F.when(F.col("l_linestatus") == "O", "USD").otherwise("EUR"),
    }
    if need & _PART_COLUMNS:
        derived["meter_category"] = F.col("p_type")
        derived["meter_sub_category"] = F.col("p_brand")
        derived["consumed_service"] = F.col("p_name")
    if need & _PLACE_COLUMNS:
        derived["resource_location"] = F.col("n_name")
    names = list(derived) if wanted is None else wanted
    return lines.select(*[derived[name].alias(name) for name in names])
