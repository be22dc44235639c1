"""Daily cost and quality counters as Structured Streaming queries.

Late records are accepted up to the watermark delay. ``drain`` emits a day once, when
the watermark has passed its end; a ``DailyTable`` has the open days too and counts the
rows that come later still.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costlens.functions.nulls import is_missing
from costlens.operators.aggregate import count_if


def read_stream(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", files_per_trigger: int | None = None
) -> DataFrame:
    """Files as a stream; ``files_per_trigger`` bounds a micro-batch."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def daily_cost_stream(
    stream: DataFrame,
    time_col: str,
    cost_col: str,
    keys: Sequence[str] = (),
    delay: str = "48 hours",
) -> DataFrame:
    """Cost and record count per day and key."""
    return (
        _dated(stream, time_col, delay)
        .groupBy(F.window("_at", "1 day"), *keys)
        .agg(F.sum(cost_col).alias("daily_cost"), F.count(F.lit(1)).alias("record_count"))
        .select(F.to_date("window.start").alias("usage_date"), *keys, "daily_cost", "record_count")
    )


def daily_quality_stream(
    stream: DataFrame,
    time_col: str,
    cost_col: str,
    currency_col: str | None = None,
    currency: str = "USD",
    delay: str = "48 hours",
) -> DataFrame:
    """Missing, negative and foreign-currency costs per day."""
    foreign = count_if(F.col(currency_col) != currency) if currency_col else F.lit(0).cast("long")
    return (
        _dated(stream, time_col, delay)
        .groupBy(F.window("_at", "1 day"))
        .agg(
            F.count(F.lit(1)).alias("record_count"),
            count_if(is_missing(stream, cost_col)).alias("missing_costs"),
            count_if(F.col(cost_col) < 0).alias("negative_costs"),
            foreign.alias("foreign_currency"),
        )
        .select(
            F.to_date("window.start").alias("usage_date"),
            "record_count",
            "missing_costs",
            "negative_costs",
            "foreign_currency",
        )
    )


def _dated(stream: DataFrame, time_col: str, delay: str) -> DataFrame:
    return stream.withColumn("_at", F.col(time_col).cast("timestamp")).withWatermark("_at", delay)


def drain(result: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> DataFrame:
    """Process what has arrived, append the finished days to a table and read
    the table back. Both paths belong in the shared folder."""
    query = (
        result.writeStream.outputMode("append")
        .format(fmt)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return result.sparkSession.read.format(fmt).schema(result.schema).load(path)


# ---- complete tables: open days, late rows --------------------------------


@dataclass(frozen=True)
class DailyTable:
    """A table of daily sums that streams feed batch by batch, below one shared folder.

    Every micro-batch adds one small row per day and key, in a folder of its own that a
    repeated batch overwrites; so each arriving row counts once, whatever was lost and run
    again. Reading adds the rows up: an upsert without rewriting. A day is in the table
    from its first row on and final once the watermark has passed its end. Rows that come
    after that are kept apart and counted, never lost.

    ``sums`` names the summed columns; ``record_count`` is always there.
    """

    spark: SparkSession
    path: str
    keys: tuple[str, ...] = ()
    sums: tuple[str, ...] = ("daily_cost",)
    delay: str = "48 hours"

    def _schema(self, stream: DataFrame) -> T.StructType:
        held = {f.name: f.dataType for f in stream.schema}
        fields = [T.StructField("usage_date", T.DateType()), *[T.StructField(k, held[k]) for k in self.keys]]
        fields += [T.StructField(s, T.LongType() if isinstance(held[s], (T.LongType, T.IntegerType)) else T.DoubleType()) for s in self.sums]
        fields += [T.StructField("record_count", T.LongType()), T.StructField("newest", T.TimestampType()), T.StructField("is_late", T.BooleanType())]
        return T.StructType([*fields, T.StructField("feed", T.StringType()), T.StructField("batch", T.LongType())])

    def _rows(self, schema: T.StructType) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/rows")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def _watermark(self) -> Column:
        return F.max("newest") - F.expr(f"INTERVAL {self.delay}")

    def write(self, rows: DataFrame, batch: int, feed: str, time_col: str) -> None:
        """Add one batch; a day that the batches before have closed takes its rows as late.

        As in a watermarked aggregate, the rows of a batch do not move the watermark that
        judges them.
        """
        schema = self._schema(rows)
        before = self._rows(schema).filter((F.col("feed") != feed) | (F.col("batch") < batch))
        closed = before.agg(self._watermark().alias("w")).first()["w"]
        at = F.col(time_col).cast("timestamp")
        day = F.to_date(at)
        ended = F.date_add(day, 1).cast("timestamp") <= F.lit(closed) if closed is not None else F.lit(False)
        types = {f.name: f.dataType for f in schema}
        summed = [F.sum(s).cast(types[s]).alias(s) for s in self.sums]
        (
            rows.groupBy(day.alias("usage_date"), *self.keys, F.coalesce(ended, F.lit(False)).alias("is_late"))
            .agg(*summed, F.count(F.lit(1)).alias("record_count"), F.max(at).alias("newest"))
            .write.mode("overwrite")
            .parquet(f"{self.path}/rows/feed={feed}/batch={batch}")
        )

    def feed(self, stream: DataFrame, time_col: str, checkpoint: str, feed: str = "main") -> tuple[DataFrame, DataFrame]:
        """Take in what has arrived on a stream; returns ``days`` and ``late_rows``.

        Several streams may feed one table, one after the other, under names and with
        checkpoints of their own.
        """
        query = (
            stream.writeStream.foreachBatch(lambda rows, batch: self.write(rows, batch, feed, time_col))
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        schema = self._schema(stream)
        return self.days(schema), self.late_rows(schema)

    def days(self, schema: T.StructType) -> DataFrame:
        """``usage_date, keys, sums, record_count, is_final`` of all days, open ones too,
        without late rows."""
        rows = self._rows(schema)
        names = [*self.sums, "record_count"]
        summed = rows.filter(~F.col("is_late") & F.col("usage_date").isNotNull()).groupBy("usage_date", *self.keys).agg(*[F.sum(s).alias(s) for s in names])
        mark = rows.agg(self._watermark().alias("w")).select("w").scalar()
        return summed.withColumn("is_final", F.coalesce(F.date_add("usage_date", 1).cast("timestamp") <= mark, F.lit(False)))

    def late_rows(self, schema: T.StructType) -> DataFrame:
        """The same sums of the rows that came after their day was closed; rows without a
        time stand under a null date."""
        late = self._rows(schema).filter(F.col("is_late") | F.col("usage_date").isNull())
        return late.groupBy("usage_date", *self.keys).agg(*[F.sum(s).alias(s) for s in [*self.sums, "record_count"]])


def daily_cost_rows(stream: DataFrame, cost_col: str) -> DataFrame:
    """Rows for a ``DailyTable`` of ``daily_cost``."""
    return stream.withColumn("daily_cost", F.col(cost_col).cast("double"))


QUALITY_SUMS = ("missing_costs", "negative_costs", "foreign_currency")


def daily_quality_rows(stream: DataFrame, cost_col: str, currency_col: str | None = None, currency: str = "USD") -> DataFrame:
    """Rows for a ``DailyTable`` of ``QUALITY_SUMS``: one flag each."""
    flag = lambda condition: F.coalesce(condition, F.lit(False)).cast("long")
    return stream.withColumns(
        {
            "missing_costs": flag(is_missing(stream, cost_col)),
            "negative_costs": flag(F.col(cost_col) < 0),
            "foreign_currency": flag(F.col(currency_col) != currency) if currency_col else F.lit(0).cast("long"),
        }
    )
