from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from costlens.operators.aggregate import daily_costs
from costlens.streaming import (
    QUALITY_SUMS,
    DailyTable,
    daily_cost_rows,
    daily_cost_stream,
    daily_quality_rows,
    daily_quality_stream,
    drain,
    read_stream,
)

SCHEMA = "ts timestamp, cost double, currency string, category string"
T = dt.datetime


def write(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_late_rows_within_the_delay_count_and_later_ones_do_not(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))

    def run():
        stream = read_stream(spark, source, spark.createDataFrame([], SCHEMA).schema)
        return {r["usage_date"].day: r["daily_cost"] for r in drain(daily_cost_stream(stream, "ts", "cost"), out, state).collect()}

    write(spark, source, [(T(2024, 1, 1, 5), 1.0, "USD", "a"), (T(2024, 1, 3, 5), 2.0, "USD", "a")])
    assert run() == {}
    # One day late: inside the 48 hours.
    write(spark, source, [(T(2024, 1, 1, 9), 10.0, "USD", "a"), (T(2024, 1, 4, 5), 4.0, "USD", "a")])
    assert run() == {1: 11.0}
    # The first day was closed; this row comes too late.
    write(spark, source, [(T(2024, 1, 1, 9), 100.0, "USD", "a"), (T(2024, 1, 9, 5), 8.0, "USD", "a")])
    assert run() == {1: 11.0, 3: 2.0, 4: 4.0}


def test_stream_equals_batch(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet")
    stream = read_stream(spark, f"{sf}/events*.parquet", events.schema)
    streamed = drain(daily_cost_stream(stream, "ts", "value", ["event_type"]), str(tmp_path / "o"), str(tmp_path / "s"))
    got = {(r["usage_date"], r["event_type"]): round(r["daily_cost"], 6) for r in streamed.collect()}
    batch = daily_costs(events.withColumn("one", F.lit(1.0)), ["event_type"], "ts", "value", "one", "one").collect()
    want = {(r["usage_date"], r["event_type"]): round(r["daily_cost"], 6) for r in batch}
    assert got and set(got) < set(want) and all(want[k] == v for k, v in got.items())


def test_quality_counters(spark, tmp_path):
    source = str(tmp_path / "in")
    day = T(2024, 1, 1, 5)
    write(spark, source, [(day, None, "USD", "a"), (day, float("nan"), "EUR", "a"), (day, -1.0, None, "a"), (T(2024, 1, 9), 1.0, "USD", "a")])
    stream = read_stream(spark, source, spark.createDataFrame([], SCHEMA).schema, files_per_trigger=1)
    row = drain(daily_quality_stream(stream, "ts", "cost", "currency"), str(tmp_path / "o"), str(tmp_path / "s")).first()
    assert tuple(row)[1:] == (3, 2, 1, 1)


def test_open_days_are_delivered_and_late_rows_counted(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path)
    target = DailyTable(spark, f"{root}/table", ("category",))

    def run():
        stream = read_stream(spark, source, spark.createDataFrame([], SCHEMA).schema)
        days, late = target.feed(daily_cost_rows(stream, "cost"), "ts", f"{root}/state")
        shown = {r["usage_date"].day: (r["daily_cost"], r["record_count"], r["is_final"]) for r in days.collect()}
        return shown, {r["usage_date"].day if r["usage_date"] else None: (r["daily_cost"], r["record_count"]) for r in late.collect()}

    write(spark, source, [(T(2024, 1, 1, 5), 1.0, "USD", "a"), (T(2024, 1, 3, 5), 2.0, "USD", "a"), (None, 5.0, "USD", "a")])
    assert run() == ({1: (1.0, 1, False), 3: (2.0, 1, False)}, {None: (5.0, 1)})
    write(spark, source, [(T(2024, 1, 1, 9), 10.0, "USD", "a"), (T(2024, 1, 4, 5), None, "USD", "a")])
    assert run()[0] == {1: (11.0, 2, True), 3: (2.0, 1, False), 4: (None, 1, False)}
    # The first day is closed; its row is counted apart.
    write(spark, source, [(T(2024, 1, 1, 9), 100.0, "USD", "a"), (T(2024, 1, 9, 5), 8.0, "USD", "a")])
    wanted = {1: (11.0, 2, True), 3: (2.0, 1, True), 4: (None, 1, True), 9: (8.0, 1, False)}, {None: (5.0, 1), 1: (100.0, 1)}
    assert run() == wanted
    # Nothing new, and a batch that is run again after a failure, change nothing.
    assert run() == wanted
    batch = spark.createDataFrame([(T(2024, 1, 1, 9), 100.0, "USD", "a"), (T(2024, 1, 9, 5), 8.0, "USD", "a")], SCHEMA)
    target.write(daily_cost_rows(batch, "cost"), 2, "main", "ts")
    assert run() == wanted


def test_batches_of_single_files_add_up_to_the_whole(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path)
    for i in range(5):
        write(spark, source, [(T(2024, 1, 1 + i, h), float(h), "EUR" if h == 3 else "USD", "a") for h in range(6)])
    stream = read_stream(spark, source, spark.createDataFrame([], SCHEMA).schema, files_per_trigger=1)
    table = DailyTable(spark, f"{root}/table", (), QUALITY_SUMS, "200 hours")
    days, late = table.feed(daily_quality_rows(stream, "cost", "currency"), "ts", f"{root}/state")
    assert {tuple(r)[1:5] for r in days.collect()} == {(0, 0, 1, 6)} and days.count() == 5 and late.count() == 0
