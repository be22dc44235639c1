"""Copies of whole rows, found by hashes first.

Counting rows by a 64-bit hash moves a few bytes per row, whatever its width. A hash that
occurs once is a row without a copy; only rows whose hash repeats are compared column by
column, so rows that merely share a hash stay apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costlens.session import materialise

# Repeated hashes that are sent to every task; with more of them the rows are shuffled.
BROADCAST_ROWS = 1_000_000
KEY = "_row_hash"


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def row_hash(df: DataFrame) -> Column:
    """One hash of all columns, equal for equal rows; also for maps, as sorted entries."""
    return F.xxhash64(*[_hashable(F.col(quoted(f.name)), f.dataType) for f in df.schema])


def _hashable(column: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.MapType):
        return F.array_sort(F.map_entries(column))
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        # As in grouping: both zeros are one value, and so are all NaN.
        return F.when(F.isnan(column), F.lit(float("nan"))).when(column == 0, F.lit(0.0)).otherwise(column)
    return column


def _split(df: DataFrame, limit: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Number of rows of each hash, the hashes that repeat, and the rows that have one."""
    hashes = materialise(df.select(row_hash(df).alias(KEY)).groupBy(KEY).agg(F.count(F.lit(1)).alias("n")))
    repeated = hashes.filter("n > 1").select(KEY)
    side = F.broadcast(repeated) if repeated.count() <= limit else repeated
    return hashes, side, df.withColumn(KEY, row_hash(df)).join(side, KEY, "left_semi").drop(KEY)


def count_distinct_rows(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """One row: ``total_records, distinct_records``; an empty table has none."""
    hashes, _, doubtful = _split(df, limit)
    one = hashes.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("total_records"), F.count_if(F.col("n") == 1).alias("_single"))
    several = doubtful.groupBy(*[F.col(quoted(c)) for c in df.columns]).agg(F.lit(1).alias("_one")).agg(F.count(F.lit(1)).alias("n"))
    return one.withColumn("_several", several.select("n").scalar()).select("total_records", (F.col("_single") + F.col("_several")).alias("distinct_records"))


def distinct_rows(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """The rows of ``df`` without copies. Rows whose hash is their own are not moved when
    the hashes that repeat can be sent to every task."""
    _, side, doubtful = _split(df, limit)
    single = df.withColumn(KEY, row_hash(df)).join(side, KEY, "left_anti").drop(KEY)
    return single.unionByName(doubtful.distinct())
