"""Exact order statistics without a global sort in one task.

Equal values are first combined into counts, which collapses hot values. The
distinct values are then range-partitioned, and running counts inside every
partition are completed by the totals of the partitions before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from costlens.operators.attach import attach
from costlens.session import materialise

# Relative rank error of the sketch is one over this.
SKETCH_ACCURACY = 10_000


def cumulative_counts(
    df: DataFrame, value_col: str, keys: Sequence[str] = (), weight_cols: Sequence[str] = ()
) -> DataFrame:
    """Distinct values per key with counts and running counts.

    Output: keys, ``value``, and for every weight ``w`` (``n`` when none is
    given: plain row counts) the columns ``w``, ``cum_w``, the total over all
    values up to and including this one, and ``total_w``, the total of the key.

    The partition number must be the same in both branches of the plan, so the
    partitioned counts are checkpointed: this operator runs one job when called.
    A hot key spreads over as many range partitions as its values need.
    """
    weights = list(weight_cols) or ["n"]
    source = df if weight_cols else df.withColumn("n", F.lit(1).cast("long"))
    value = F.col(value_col)
    # A struct never is null and equals itself also with null fields, so the
    # join below is a plain equality on the partitioning the window already has.
    key = F.struct(*keys) if keys else F.struct(F.lit(0).alias("all"))
    counts = (
        source.filter(value.isNotNull())
        .groupBy(key.alias("_key"), value.alias("value"))
        .agg(*[F.sum(w).alias(w) for w in weights])
    )
    ranged = materialise(
        counts.repartitionByRange("_key", "value").withColumn("_part", F.spark_partition_id())
    )
    inside = W.partitionBy("_key", "_part").orderBy("value").rowsBetween(W.unboundedPreceding, 0)
    # One row per key and range partition from here on.
    totals = ranged.groupBy("_key", "_part").agg(*[F.sum(w).alias(f"_t_{w}") for w in weights])
    before = W.partitionBy("_key").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy("_key")
    offsets = totals.select(
        "_key",
        "_part",
        *[F.coalesce(F.sum(f"_t_{w}").over(before), F.lit(0)).alias(f"_o_{w}") for w in weights],
        *[F.sum(f"_t_{w}").over(whole).alias(f"total_{w}") for w in weights],
    )
    running = ranged.select("*", *[F.sum(w).over(inside).alias(f"_c_{w}") for w in weights])
    joined = running.join(offsets, ["_key", "_part"])
    out = [F.col(f"_key.{k}").alias(k) for k in keys] + [F.col("value")]
    for w in weights:
        out += [F.col(w), (F.col(f"_c_{w}") + F.col(f"_o_{w}")).alias(f"cum_{w}"), F.col(f"total_{w}")]
    return joined.select(*out)


def exact_quantiles(
    df: DataFrame,
    value_col: str,
    probabilities: Sequence[float],
    keys: Sequence[str] = (),
    narrow: bool = False,
) -> DataFrame:
    """Exact, linearly interpolated quantiles per key: one row per key with an
    array ``quantiles`` in the order of ``probabilities``. Runs jobs.

    ``narrow=True`` is for raw rows: a mergeable sketch brackets every quantile
    first, then one more scan keeps single values only inside the brackets and
    lumps the values between them. The result stays exact while the shuffle
    carries a few ten-thousandths of the rows.
    """
    if not narrow:
        return quantiles_from_counts(cumulative_counts(df, value_col, keys), probabilities, keys)
    compressed = _compress(df, value_col, probabilities, keys)
    return quantiles_from_counts(cumulative_counts(compressed, "value", keys, ["n"]), probabilities, keys)


def _compress(df: DataFrame, value_col: str, probabilities: Sequence[float], keys: Sequence[str]) -> DataFrame:
    """``keys, value, n``: single values inside a bracket, and each stretch
    between brackets as its smallest value once and its largest value for the
    rest.

    A bracket is two sketch errors wide on both sides, so the wanted ranks lie
    inside it or are the next rank outside, and the ends of a stretch are true
    values at their true ranks.
    """
    margin = 2.0 / SKETCH_ACCURACY
    low = [max(float(p) - margin, 0.0) for p in probabilities]
    high = [min(float(p) + margin, 1.0) for p in probabilities]
    rows = df.filter(F.col(value_col).isNotNull()).select(*keys, F.col(value_col).alias("_v"))
    sketch = rows.groupBy(*keys).agg(F.percentile_approx("_v", low + high, SKETCH_ACCURACY).alias("_bounds"))
    bounded = attach(rows, sketch, keys)
    m, v = len(low), F.col("_v")
    inside, stretch = F.lit(False), F.lit(0)
    for i in range(m):
        inside = inside | ((v >= F.col("_bounds")[i]) & (v <= F.col("_bounds")[m + i]))
        stretch = stretch + (v > F.col("_bounds")[m + i]).cast("int")
    grouped = (
        bounded.select(*keys, "_v", inside.alias("_inside"), stretch.alias("_stretch"))
        .groupBy(
            *keys,
            F.when(F.col("_inside"), v).alias("_single"),
            F.when(~F.col("_inside"), F.col("_stretch")).alias("_stretch"),
        )
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_min"), F.max("_v").alias("_max"))
    )
    entry = lambda value, n: F.struct(F.col(value).alias("value"), n.cast("long").alias("n"))
    entries = (
        F.when(F.col("_single").isNotNull(), F.array(entry("_single", F.col("_n"))))
        .when(F.col("_n") == 1, F.array(entry("_min", F.lit(1))))
        .otherwise(F.array(entry("_min", F.lit(1)), entry("_max", F.col("_n") - 1)))
    )
    return grouped.select(*keys, F.explode(entries).alias("_e")).select(*keys, "_e.value", "_e.n")


def quantiles_from_counts(
    counts: DataFrame, probabilities: Sequence[float], keys: Sequence[str] = (), weight: str = "n"
) -> DataFrame:
    """Quantiles of one weight of a ``cumulative_counts`` frame: the order
    statistics around every wanted rank, interpolated."""
    size = F.col(f"total_{weight}")
    wanted = F.array(
        *[
            F.struct(F.lit(i).alias("i"), (F.lit(float(p)) * (size - 1)).alias("at"))
            for i, p in enumerate(probabilities)
        ]
    )
    # A value covers the zero-based ranks [cum - n, cum - 1].
    first, last = F.col(f"cum_{weight}") - F.col(weight), F.col(f"cum_{weight}") - 1

    def covers(rank: Column, lo: Column, hi: Column) -> Column:
        return (rank >= lo) & (rank <= hi)

    hits = F.filter(
        wanted, lambda x: covers(F.floor(x["at"]), first, last) | covers(F.ceil(x["at"]), first, last)
    )
    picked = (
        counts.filter(F.col(weight) > 0)
        .withColumn("_hits", hits)
        .filter(F.size("_hits") > 0)
        .select(*keys, "value", first.alias("_first"), last.alias("_last"), F.explode("_hits").alias("_hit"))
    )
    at = F.col("_hit.at")
    side = lambda rank: F.max(F.when(covers(rank, F.col("_first"), F.col("_last")), F.col("value")))
    solved = picked.groupBy(*keys, F.col("_hit.i").alias("_i"), at.alias("_at")).agg(
        side(F.floor(at)).alias("_low"), side(F.ceil(at)).alias("_high")
    )
    point = F.col("_low") + (F.col("_high") - F.col("_low")) * (F.col("_at") - F.floor("_at"))
    # At most one entry per probability.
    return solved.groupBy(*keys).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct(F.col("_i"), point.alias("q")))), lambda x: x["q"]
        ).alias("quantiles")
    )
