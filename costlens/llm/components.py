"""Connected components of a table of links."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlens.session import materialise

TASK_LINKS = 50_000


def connected_components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """``id, component`` of every row that has a link; ``links`` has ``a, b``.

    The component is the smallest id that can be reached. Alternates large-star and
    small-star rounds: the neighbours of a node are pointed at the smallest of them, so
    that chains shrink geometrically and a hub never gathers its neighbours in one row
    (only minima are aggregated, which combine on the map side). Each round is cut by a
    checkpoint. Null and self links are ignored.
    """
    edges = materialise(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("a IS NOT NULL AND b IS NOT NULL AND a <> b").distinct()
    )
    # A table of few links runs in few tasks.
    tasks = max(1, math.ceil(edges.count() / TASK_LINKS))
    before = None
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).coalesce(tasks).withColumn("m", F.least("u", "m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).coalesce(tasks).distinct().coalesce(tasks)
        small = large.groupBy("u").agg(F.min("v").alias("m")).coalesce(tasks)
        pointed = (
            large.join(small, "u")
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.*")
            .filter("u <> v")
            .coalesce(tasks)
            .distinct()
            .coalesce(tasks)
        )
        edges = materialise(pointed)
        # Equal sums of two hashes mean the same set of edges.
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = edges.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
