"""Streaming daily cost and quality counters, kept in complete daily tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from costlens.session import scratch_path
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
from costlens.workload.base import query, rounded, table

# A day is finished when the watermark, 48 hours behind the newest event, has
# passed its end.
FINISHED = "CAST(ts AS DATE) + 1 <= (SELECT MAX(ts) - INTERVAL 48 HOUR FROM events)"


def _stream(spark, sf):
    schema = table(spark, sf, "events").schema
    return read_stream(spark, f"{sf}/events*.parquet", schema)


def _drained(spark, result, label):
    root = scratch_path(spark, label)
    return drain(result, f"{root}/table", f"{root}/checkpoint")


def _damaged(stream):
    kind, value = F.col("event_type"), F.col("value")
    return stream.withColumns(
        {
            "value": F.when(kind == "view", F.lit(float("nan"))).when(kind == "error", -value).otherwise(value),
            "currency": F.when(kind == "click", "EUR").otherwise("USD"),
        }
    )


@query(
    "st1_streaming_daily_cost",
    f"""SELECT CAST(ts AS DATE) AS usage_date, event_type, ROUND(SUM(value), 4) AS daily_cost, COUNT(*)::BIGINT AS record_count,
  BOOL_AND({FINISHED}) AS is_final FROM events GROUP BY 1, 2""",
)
def st1(spark, sf):
    """All days, open ones too."""
    root = scratch_path(spark, "daily-cost")
    target = DailyTable(spark, f"{root}/table", ("event_type",))
    days, _ = target.feed(daily_cost_rows(_stream(spark, sf), "value"), "ts", f"{root}/checkpoint")
    return rounded(days)


@query(
    "st2_streaming_quality",
    f"""SELECT CAST(ts AS DATE) AS usage_date, COUNT(*)::BIGINT AS record_count,
  COUNT_IF(event_type = 'view')::BIGINT AS missing_costs, COUNT_IF(event_type = 'error' AND value > 0)::BIGINT AS negative_costs,
  COUNT_IF(event_type = 'click')::BIGINT AS foreign_currency, BOOL_AND({FINISHED}) AS is_final FROM events GROUP BY 1""",
)
def st2(spark, sf):
    root = scratch_path(spark, "daily-quality")
    target = DailyTable(spark, f"{root}/table", (), QUALITY_SUMS)
    days, _ = target.feed(daily_quality_rows(_damaged(_stream(spark, sf)), "value", "currency"), "ts", f"{root}/checkpoint")
    return days


SECOND = "event_id % 10 = 0"


@query(
    "st1_late_rows",
    f"""SELECT CAST(ts AS DATE) AS usage_date, event_type, ROUND(SUM(value), 4) AS daily_cost, COUNT(*)::BIGINT AS record_count FROM events
WHERE {SECOND} AND CAST(ts AS DATE) + 1 <= (SELECT MAX(ts) - INTERVAL 48 HOUR FROM events WHERE NOT ({SECOND})) GROUP BY 1, 2""",
)
def st1_late(spark, sf):
    """A tenth of the events comes in a second feed, when most days are closed."""
    root = scratch_path(spark, "late-rows")
    target = DailyTable(spark, f"{root}/table", ("event_type",))
    rows = daily_cost_rows(_stream(spark, sf), "value")
    target.feed(rows.filter(f"NOT ({SECOND})"), "ts", f"{root}/checkpoint-1", "first")
    return rounded(target.feed(rows.filter(SECOND), "ts", f"{root}/checkpoint-2", "second")[1])


@query(
    "st1_finished_days",
    f"""SELECT CAST(ts AS DATE) AS usage_date, event_type, ROUND(SUM(value), 4) AS daily_cost, COUNT(*) AS record_count
FROM events WHERE {FINISHED} GROUP BY 1, 2""",
)
def st1_finished(spark, sf):
    """Append mode: each day once, when it is finished."""
    return rounded(_drained(spark, daily_cost_stream(_stream(spark, sf), "ts", "value", ["event_type"]), "finished-cost"))


@query(
    "st2_finished_days",
    f"""SELECT CAST(ts AS DATE) AS usage_date, COUNT(*) AS record_count,
  COUNT_IF(event_type = 'view')::BIGINT AS missing_costs, COUNT_IF(event_type = 'error' AND value > 0)::BIGINT AS negative_costs,
  COUNT_IF(event_type = 'click')::BIGINT AS foreign_currency FROM events WHERE {FINISHED} GROUP BY 1""",
)
def st2_finished(spark, sf):
    return _drained(spark, daily_quality_stream(_damaged(_stream(spark, sf)), "ts", "value", "currency"), "finished-quality")
