"""Joining per-segment statistics to rows without moving the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlens.session import materialise

# Statistics of more segments than this are joined by a shuffle.
BROADCAST_ROWS = 100_000


def attach(df: DataFrame, stats: DataFrame, keys: Sequence[str], limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with the columns of ``stats``, matched on ``keys`` (nulls match).

    The statistics are checkpointed and counted first (one job). Up to ``limit``
    rows they are broadcast, so neither the rows nor a hot segment move; beyond
    it the join shuffles, and adaptive execution splits skewed segments. Without
    keys ``stats`` is a single row.
    """
    extra = [name for name in stats.columns if name not in keys]
    if not keys:
        return df.withColumn("_stats", stats.select(F.struct(*extra)).scalar()).select("*", "_stats.*").drop("_stats")
    known = materialise(stats)
    side = F.broadcast(known) if known.count() <= limit else known
    match = [F.col(f"d.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys]
    return df.alias("d").join(side.alias("s"), match, "left").select("d.*", *[f"s.{name}" for name in extra])
