"""Structured Streaming: daily cost and quality counters."""
from costlens.streaming.daily import (
    QUALITY_SUMS,
    DailyTable,
    daily_cost_rows,
    daily_cost_stream,
    daily_quality_rows,
    daily_quality_stream,
    drain,
    read_stream,
)

__all__ = [
    "QUALITY_SUMS", "DailyTable", "daily_cost_rows", "daily_cost_stream", "daily_quality_rows", "daily_quality_stream", "drain", "read_stream",
]
