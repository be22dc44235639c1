from __future__ import annotations

import datetime as dt
import pathlib

import pytest
from pyspark.sql import functions as F

from costlens.models.baseline import by_horizon, naive
from costlens.session import scratch_path, shared_dir
from costlens.sources import (
    RAW_SCHEMA,
    cost_records,
    filter_records,
    latest_forecast_run,
    load_records,
    map_attributes,
    read_csv,
    write_forecast_csv,
    write_forecast_table,
    write_records,
)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_raw_schema_has_the_declared_columns():
    assert len(RAW_SCHEMA) == 23 and RAW_SCHEMA["usage_date"].dataType.simpleString() == "date"


def test_date_bounds_are_inclusive_on_timestamps(spark):
    rows = [(dt.datetime(2024, 1, 1, 0, 0),), (dt.datetime(2024, 1, 2, 23, 59),), (dt.datetime(2024, 1, 3, 0, 0),)]
    df = spark.createDataFrame(rows, "usage_date timestamp_ntz")
    assert filter_records(df, "2024-01-01", "2024-01-02").count() == 2


def test_total_means_all_categories(spark):
    df = spark.createDataFrame([("a",), ("b",)], "meter_category string")
    assert filter_records(df, category="Total").count() == 2 and filter_records(df, category="a").count() == 1


def test_legacy_names_are_mapped_and_cast(spark):
    df = spark.createDataFrame([("2024-01-01 10:00:00", "1.5", "x", 7)], "UsageDateTime string, PreTaxCost string, ServiceTier string, other int")
    row = map_attributes(df).first().asDict()
    assert row == {"usage_date": dt.date(2024, 1, 1), "cost_in_billing_currency": 1.5, "plan_name": "x", "other": 7}


def test_scan_reads_needed_columns_and_pushes_dates(spark, sf):
    records = filter_records(cost_records(spark, sf, ["usage_date", "quantity"]), "1996-01-01", "1996-01-31")
    plan = plan_of(records)
    assert plan.count("FileScan") == 1 and "GreaterThanOrEqual(l_shipdate" in plan
    assert "ReadSchema: struct<l_quantity:double,l_shipdate:timestamp_ntz>" in plan


def test_category_filter_reaches_the_dimension(spark, sf):
    plan = plan_of(filter_records(cost_records(spark, sf, ["meter_category", "quantity"]), category="PROMO"))
    assert "EqualTo(p_type,PROMO)" in plan


def test_lines_without_dimension_keep_their_cost(spark, sf):
    lines = spark.read.parquet(f"{sf}/lineitem.parquet")
    assert cost_records(spark, sf).count() == lines.count()


def test_round_trip_with_pruned_months(spark, tmp_path):
    path = str(tmp_path / "records")
    df = spark.sql("select explode(sequence(date'2024-01-01', date'2024-03-31', interval 1 day)) as usage_date").withColumn("c", F.lit(1.0))
    write_records(df, path)
    assert sorted(p.name for p in pathlib.Path(path).glob("usage_month=*")) == [f"usage_month=2024-0{m}" for m in (1, 2, 3)]
    loaded = load_records(spark, path, "2024-02-10", "2024-02-11", fmt="parquet")
    assert loaded.count() == 2
    pruned = spark.read.parquet(path).filter(F.col("usage_month") == "2024-02")
    assert "PartitionFilters: [isnotnull(usage_month" in plan_of(pruned)


def test_csv(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text(",".join(RAW_SCHEMA.names) + "\n" + ",".join("2024-01-01" if n == "usage_date" else "1" for n in RAW_SCHEMA.names) + "\n")
    row = read_csv(spark, str(path)).first()
    assert row["usage_date"] == dt.date(2024, 1, 1) and row["quantity"] == 1.0 and row["tags"] == "1"


def test_forecast_sinks(spark, series_of, tmp_path):
    forecasts = by_horizon(naive(series_of({"s": [1], "t u": [2]}), 5).withColumn("model", F.lit("naive")), [2, 5])
    csv, runs = str(tmp_path / "csv"), str(tmp_path / "runs")
    write_forecast_csv(forecasts, csv)
    back = spark.read.csv(csv, header=True)
    assert back.count() == 14 and {"segment", "horizon_days"} <= set(back.columns)
    write_forecast_table(forecasts, runs, F.lit("2024-01-01 06:00:00"))
    write_forecast_table(forecasts.filter("segment = 's'"), runs, F.lit("2024-01-02 06:00:00"))
    latest = latest_forecast_run(spark.read.parquet(runs))
    newest = {(r["segment"], r["generated_at"].day) for r in latest.collect()}
    assert newest == {("s", 2), ("t u", 1)} and latest.count() == 14


class FakeSession:
    """Just the parts of a session that name the shared folder."""

    def __init__(self, master, configured):
        self.folder = None
        self.sparkContext = self
        self.master = master
        self.conf = {"spark.checkpoint.dir": configured} if configured else {}

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_shared_folder_comes_from_the_session():
    named = FakeSession("yarn", "hdfs://cluster/shared")
    assert shared_dir(named) == "hdfs://cluster/shared" == named.folder
    assert scratch_path(named, "x").startswith("hdfs://cluster/shared/x-")


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(ValueError):
        shared_dir(FakeSession("spark://host:7077", None))
    assert shared_dir(FakeSession("local[2]", None)).startswith("/")


def test_unknown_format_is_an_error(spark, tmp_path):
    with pytest.raises(Exception):
        load_records(spark, str(tmp_path / "nothing"), fmt="parquet").count()


def test_catalog_tables(spark, tmp_path):
    df = spark.sql("select explode(sequence(date'2024-01-01', date'2024-02-10', interval 1 day)) as usage_date").withColumn("meter_category", F.lit("a"))
    spark.sql(f"create database if not exists costs location '{tmp_path / 'db'}'")
    write_records(df, "costs.records", as_table=True)
    assert load_records(spark, "costs.records", "2024-02-01").count() == 10
    spark.sql("drop table costs.records")
