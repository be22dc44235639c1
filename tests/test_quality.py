from __future__ import annotations

import datetime as dt

import pytest

from costlens.operators import aggregate as agg
from costlens.operators import quality as q
from costlens.sources.records import RAW_SCHEMA

NAN = float("nan")
SCHEMA = "usage_date date, cost_in_billing_currency double, meter_category string, resource_location string, billing_currency_code string"
DAY = dt.date(2024, 1, 1)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_completeness_counts_null_and_nan(spark):
    df = frame(spark, [(DAY, 1.0, "a", "x", "USD"), (DAY, NAN, "a", None, "USD"), (None, None, None, "x", None)])
    row = q.completeness(df).first()
    assert (row["total_records"], row["missing_cells"]) == (3, 6)
    assert row["completeness_rate"] == pytest.approx(-100.0)
    assert row["cell_completeness_rate"] == pytest.approx(60.0)
    assert row["meets_threshold"] is False
    long = {r["column"]: r for r in q.missing_by_column(df).collect()}
    assert long["cost_in_billing_currency"]["missing_count"] == 2
    assert long["usage_date"]["alert_level"] == "CRITICAL"


def test_absent_columns_are_skipped(spark):
    row = q.completeness(frame(spark, [(DAY, 1.0, "a", "x", "USD")]).drop("resource_location")).first()
    assert row["completeness_rate"] == 100.0 and row["meets_threshold"] is True


def test_empty_frame(spark):
    empty = frame(spark, [])
    row = q.completeness(empty).first()
    assert row["total_records"] == 0 and row["completeness_rate"] == 0
    assert q.consistency(empty).first()["duplicate_pct"] == 0
    fresh = q.timeliness(empty, "2024-01-02 00:00:00").first()
    assert fresh["latest_date"] is None and fresh["meets_sla"] is False
    available = agg.data_availability(empty, "2024-01-02 00:00:00").first()
    assert available["is_available"] is False and available["is_fresh"] is False
    assert q.quality_report(empty, "2024-01-02 00:00:00").first()["below_gate"] is True


def test_accuracy_ignores_null_currency(spark):
    df = frame(spark, [(DAY, -1.0, "a", "x", "USD"), (DAY, 0.0, "a", "x", "EUR"), (DAY, 2.0, "a", "x", None)])
    row = q.accuracy(df).first()
    assert (row["negative_costs"], row["zero_costs"], row["foreign_currency"], row["has_issues"]) == (1, 1, 1, True)
    assert row["min_date"] == row["max_date"] == DAY


def test_duplicates(spark):
    df = frame(spark, [(DAY, 1.0, "a", None, "USD")] * 3 + [(DAY, 2.0, "a", "x", "USD")])
    row = q.consistency(df).first()
    assert (row["total_records"], row["distinct_records"], row["duplicate_count"]) == (4, 2, 2)
    assert row["duplicate_pct"] == 50.0


def test_timeliness_limit_is_inclusive(spark):
    df = frame(spark, [(DAY, 1.0, "a", "x", "USD")])
    assert q.timeliness(df, "2024-01-08 00:00:00", 168).first()["meets_sla"] is True
    late = q.timeliness(df, "2024-01-08 01:00:00", 168).first()
    assert late["meets_sla"] is False and late["hours_old"] == 169


def test_score(spark):
    df = frame(spark, [(DAY, 1.0, "a", "x", "USD")])
    row = q.quality_report(df, "2024-01-02 00:00:00").first()
    assert row["quality_score"] == pytest.approx(100) and row["below_gate"] is False
    bad = frame(spark, [(DAY, -1.0, "a", None, "EUR")] * 2)
    row = q.quality_report(bad, "2025-01-02 00:00:00").first()
    assert row["quality_score"] == pytest.approx(0.3 * 0 + 0.3 * 80 + 0.2 * 90 + 0.2 * 70)
    assert row["below_gate"] is True


def test_report_scans_once_and_shuffles_the_copies_once(spark, sf):
    from costlens.sources import cost_records

    plan = q.quality_report(cost_records(spark, sf, ["usage_date", "cost_in_billing_currency", "quantity"]), "2001-11-08 00:00:00")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 2


def test_schema_check(spark):
    out = {r["column"]: r for r in q.schema_check(frame(spark, []), RAW_SCHEMA).collect()}
    assert out["usage_date"]["ok"] is True
    assert out["tags"]["actual"] is None and out["tags"]["ok"] is False


def test_cast_failures(spark):
    df = spark.createDataFrame([("2024-01-01", "1.5"), ("yesterday", None)], "usage_date string, quantity string")
    out = {r["column"]: r["failures"] for r in q.cast_failures(df, RAW_SCHEMA).collect()}
    assert out == {"usage_date": 1, "quantity": 0}


def test_segment_levels_keep_the_raw_mean(spark):
    rows = [
        (DAY, "a", "x", 1.0, 1.0, 10.0),
        (DAY, "a", "x", 2.0, 1.0, 20.0),
        (DAY, "a", "y", 3.0, 1.0, 60.0),
        (DAY, None, "y", 4.0, None, None),
    ]
    df = spark.createDataFrame(
        rows,
        "usage_date date, meter_category string, resource_location string, cost_in_billing_currency double, quantity double, effective_price double",
    )
    out = {(r["segment_level"], r["segment"]): r for r in agg.segment_daily_costs(df).collect()}
    assert out["total", "Total"]["daily_cost"] == 10 and out["total", "Total"]["avg_rate"] == 30
    assert out["category", "a"]["avg_rate"] == 30
    assert out["category", "Unknown"]["avg_rate"] is None
    assert out["category_region", "a|x"]["daily_cost"] == 3
    assert out["region", "y"]["daily_cost"] == 7


def test_tags(spark):
    df = spark.createDataFrame([('{"env": "prod"}', 2.0), (None, 1.0), ('{"env": "prod", "t": "1"}', 3.0)], "tags string, c double")
    out = {(r["tag_key"], r["tag_value"]): r["total_cost"] for r in agg.cost_by_tag(df, "tags", "c").collect()}
    assert out == {("env", "prod"): 5.0, ("t", "1"): 3.0}


def test_optional_measures(spark):
    df = spark.createDataFrame([(DAY, 2.0)], "usage_date date, cost_in_billing_currency double")
    row = agg.daily_costs(df).first()
    assert row["daily_cost"] == 2 and row["total_quantity"] is None and row["avg_rate"] is None


@pytest.mark.parametrize(
    "call",
    [
        lambda df: q.completeness(df, threshold_pct=101),
        lambda df: q.missing_alert(1, 5, -1),
        lambda df: q.timeliness(df, "2024-01-01 00:00:00", -1),
        lambda df: agg.data_availability(df, "2024-01-01 00:00:00", -0.5),
        lambda df: agg.minimum_history(df, 0),
        lambda df: agg.region_share_deviation(df, {"x": 1.5}),
    ],
)
def test_bounds(spark, call):
    with pytest.raises(ValueError):
        call(frame(spark, []))


@pytest.mark.parametrize("limit", [0, 1000])
def test_copies_of_whole_rows(spark, monkeypatch, limit):
    import datetime as dt

    from pyspark.sql import functions as F

    from costlens.operators import duplicates

    day, nan = dt.date(2024, 1, 1), float("nan")
    rows = [(1, "a", 1.5, day, [1, 2], {"x": 1, "y": 2}), (1, "a", 1.5, day, [1, 2], {"y": 2, "x": 1}), (2, None, None, None, None, None), (2, None, None, None, None, None), (3, "", 0.0, day, [], {}), (3, "", -0.0, day, [], {}), (4, "a", nan, day, [None], None), (4, "a", nan, day, [None], None), (5, "b", 1.0, day, None, None)]
    frame = spark.createDataFrame(rows, "i int, s string, d double, t date, a array<int>, m map<string,int>").repartition(3)
    plain = frame.drop("m").withColumn("odd`name", F.lit(1))
    for df in (plain, frame.withColumn("m", F.array_sort(F.map_entries("m")))):
        row = duplicates.count_distinct_rows(df, limit).first()
        assert (row["total_records"], row["distinct_records"]) == (9, 5)
        assert sorted(r["i"] for r in duplicates.distinct_rows(df, limit).collect()) == [1, 2, 3, 4, 5]
    assert frame.select(duplicates.row_hash(frame)).distinct().count() == 5
    assert tuple(duplicates.count_distinct_rows(plain.limit(0), limit).first()) == (0, 0)
    assert duplicates.distinct_rows(plain.limit(0), limit).count() == 0
    # Rows that share a hash are compared column by column.
    monkeypatch.setattr(duplicates, "row_hash", lambda df: F.lit(7).cast("long"))
    assert duplicates.count_distinct_rows(plain, limit).first()["distinct_records"] == 5
    assert duplicates.distinct_rows(plain, limit).count() == 5


def test_rows_without_copies_move_as_hashes(spark):
    """The exchange of a table without copies has a hash and a count, no columns."""
    from costlens.operators import duplicates

    frame = spark.range(1000).selectExpr("id", "repeat('wide', 200) AS text", "id % 7 AS k")
    hashes = frame.select(duplicates.row_hash(frame).alias(duplicates.KEY)).groupBy(duplicates.KEY).count()
    assert {f.name for f in hashes.schema} == {duplicates.KEY, "count"}
    assert duplicates.count_distinct_rows(frame).first()["distinct_records"] == 1000
