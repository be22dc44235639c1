"""Writing records and forecasts, and reading the latest forecast run back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, DataFrameWriter
from pyspark.sql import functions as F


def _store(writer: DataFrameWriter, target: str, as_table: bool) -> None:
    writer.saveAsTable(target) if as_table else writer.save(target)


def write_records(
    df: DataFrame,
    target: str,
    date_col: str = "usage_date",
    fmt: str = "parquet",
    mode: str = "overwrite",
    as_table: bool = False,
) -> None:
    """Store records in one folder per usage month, so that date bounds prune
    folders. ``target`` is a path, or a catalog name with ``as_table``.

    The rebalance hint gathers the rows of a month, and adaptive execution
    splits a large month into writers of the advisory partition size.
    """
    months = df.withColumn("usage_month", F.date_format(F.col(date_col), "yyyy-MM")).hint("rebalance", "usage_month")
    _store(months.write.mode(mode).partitionBy("usage_month").format(fmt), target, as_table)


def write_forecast_csv(forecasts: DataFrame, path: str, mode: str = "append") -> None:
    """One folder per (segment, horizon), CSV with a header."""
    (
        forecasts.repartition("segment", "horizon_days")
        .write.mode(mode)
        .partitionBy("segment", "horizon_days")
        .option("header", True)
        .csv(path)
    )


def write_forecast_table(
    forecasts: DataFrame,
    target: str,
    generated_at: Column,
    fmt: str = "parquet",
    mode: str = "append",
    as_table: bool = False,
) -> None:
    """Forecasts with intervals and model metadata, one folder per run date."""
    run = forecasts.withColumn("generated_at", generated_at.cast("timestamp")).withColumn(
        "generated_date", F.to_date("generated_at")
    )
    _store(run.write.mode(mode).partitionBy("generated_date").format(fmt), target, as_table)


def latest_forecast_run(
    forecasts: DataFrame, keys: Sequence[str] = ("segment", "horizon_days"), run_col: str = "generated_at"
) -> DataFrame:
    """Rows of the newest run of every key.

    The newest run time per key comes from a map-side combined aggregate and
    joins back, so a key with a long run history is never sorted in one task.
    """
    newest = forecasts.groupBy(*keys).agg(F.max(run_col).alias("_newest"))
    condition = [F.col(f"f.{key}").eqNullSafe(F.col(f"n.{key}")) for key in keys]
    condition.append(F.col(f"f.{run_col}") == F.col("n._newest"))
    return forecasts.alias("f").join(newest.alias("n"), condition, "left_semi")
