"""Exact top-k by inner product over a pivot-distance index.

A vector x gets one more component, sqrt(M2 - |x|^2) for the largest squared norm M2, so
that all have one length; a query gets 0. Then |q - x|^2 = |q|^2 + M2 - 2 <q, x>, and the
highest inner products belong to the nearest vectors. The index keys each vector by its
nearest pivot and a ring of distances from it. As |q - x| >= | |q - p| - |x - p| |, a ring
bounds the products of its vectors from above.

Search first scores each query against the rings nearest to it until these hold k vectors
or more; the k-th score found is a floor. It then expands over the rings of all pivots whose
bound reaches the floor, and no others: no vector left out can score higher, or equal with
a smaller id. Rings are scored in blocks, so a common vector does not make one large task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from costlens.session import materialise

PIVOTS, RINGS = 64, 16
SAMPLE = 20_000  # vectors from which pivots are chosen; all are indexed
BLOCK_ROWS, BLOCK_QUERIES = 4096, 2048
EXACT = 1 << 53

HITS = "query_id long, vec_id long, score long"


def whole_numbers(vectors: DataFrame, scale: int) -> DataFrame:
    """``vec_id, v`` of vectors without nulls and non-finite components."""
    x = F.col("embedding").cast("array<double>")
    sound = x.isNotNull() & F.coalesce(F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))), F.lit(False))
    return vectors.filter(sound & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(c * scale).cast("double")).alias("v")
    )


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    return np.stack(column.to_list()).reshape(len(column), width) if len(column) else np.empty((0, width))


def choose_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Far-apart vectors of the sample, each the farthest from those before."""
    chosen = [sample[0]]
    away = ((sample - chosen[0]) ** 2).sum(axis=1)
    while len(chosen) < count and away.max() > 0:
        chosen.append(sample[int(away.argmax())])
        away = np.minimum(away, ((sample - chosen[-1]) ** 2).sum(axis=1))
    return np.stack(chosen)


def _placer(pivots: np.ndarray, top: float):
    """Nearest pivot and distance of each vector in the lengthened space."""
    spare = np.sqrt(np.maximum(0.0, top - (pivots**2).sum(axis=1)))
    long = np.hstack([pivots, spare[:, None]])

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            x = _matrix(frame["v"], pivots.shape[1])
            x = np.hstack([x, np.sqrt(np.maximum(0.0, top - (x**2).sum(axis=1)))[:, None]])
            d = np.sqrt(np.maximum(0.0, (x**2).sum(axis=1)[:, None] + (long**2).sum(axis=1) - 2 * x @ long.T))
            near = d.argmin(axis=1)
            yield pd.DataFrame({"vec_id": frame["vec_id"], "v": frame["v"], "pivot": near.astype("int32"), "away": d[np.arange(len(d)), near]})

    return place


def _router(pivots: np.ndarray, top: float, rings: pd.DataFrame, k: int, first: bool, blocks: dict):
    """Rings that a query visits: the nearest ones, or all that reach its floor."""
    spare = np.sqrt(np.maximum(0.0, top - (pivots**2).sum(axis=1)))
    pivot, low, high = (rings[c].to_numpy() for c in ("pivot", "low", "high"))
    size, ring = rings["n"].to_numpy(), rings["ring"].to_numpy()
    # Room for rounding in distances; bounds may only come out too high.
    slack = 1e-6 * (1 + math.sqrt(top))

    def route(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            q = _matrix(frame["v"], pivots.shape[1])
            norm = (q**2).sum(axis=1)
            d = np.sqrt(np.maximum(0.0, norm[:, None] + (pivots**2).sum(axis=1) + spare**2 - 2 * q @ pivots.T))[:, pivot]
            gap = np.maximum(0.0, np.maximum(d - high, low - d) - slack)
            bound = (norm[:, None] + top - gap**2) / 2 + slack
            if first:
                order = np.argsort(-bound, axis=1, kind="stable")
                held = np.cumsum(size[order], axis=1) - size[order]
                visit = np.zeros(bound.shape, dtype=bool)
                np.put_along_axis(visit, order, held < 4 * (k + 1), axis=1)
            else:
                floor = frame["floor"].to_numpy(dtype=float)
                visit = bound >= np.where(np.isnan(floor), -np.inf, floor)[:, None]
                visit &= ~_visited(frame["seen"], len(ring))
            row, col = np.nonzero(visit)
            out = pd.DataFrame({"query_id": frame["vec_id"].to_numpy()[row], "q": frame["v"].to_numpy()[row], "pivot": pivot[col], "ring": ring[col], "at": col.astype("int32")})
            # An object column also when no ring is left to visit.
            out["block"] = pd.Series([list(range(blocks[p, r])) for p, r in zip(out["pivot"], out["ring"])], dtype=object)
            yield out

    return route


def _visited(seen: pd.Series, n: int) -> np.ndarray:
    out = np.zeros((len(seen), n), dtype=bool)
    for i, x in enumerate(seen):
        if x is not None:
            out[i, np.asarray(x, dtype=np.int64)] = True
    return out


def _scorer(k: int):
    def score(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(rows):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        rows = rows.sort_values("vec_id", kind="stable")
        width = len(rows["v"].iloc[0])
        x, ids = _matrix(rows["v"], width), rows["vec_id"].to_numpy()
        found = []
        for a in range(0, len(queries), 512):
            part = queries.iloc[a : a + 512]
            q = _matrix(part["q"], width)
            # Products of whole numbers are exact in doubles below 2**53.
            if np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * width < EXACT:
                s = (q @ x.T).astype(np.int64)
            else:
                s = np.array([[sum(int(i) * int(j) for i, j in zip(u, w)) for w in x] for u in q], dtype=np.int64)
            for query_id, scores in zip(part["query_id"], s):
                keep = np.flatnonzero(ids != query_id)
                if len(keep) > k:
                    floor = np.partition(scores[keep], len(keep) - k)[len(keep) - k]
                    keep = keep[scores[keep] >= floor]
                    keep = keep[np.argsort(-scores[keep], kind="stable")][:k]
                found.append(pd.DataFrame({"query_id": query_id, "vec_id": ids[keep], "score": scores[keep]}))
        return pd.concat(found, ignore_index=True)

    return score


def top_products(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: int = 256, pivots: int = PIVOTS, rings: int = RINGS) -> DataFrame:
    """The ``k`` highest integer inner products of each query over all vectors.

    Both tables hold ``vec_id, embedding``; components become ``floor(scale * x)``. A row
    is never its own neighbour (same ``vec_id``). Ties go to the smaller ``vec_id``. A
    vector that is null, or holds a null or non-finite component, takes no part, nor does
    one without an id or of another length than the most common one. Rows that repeat an
    id and vector count once. Other columns are ignored; an empty table gives an empty
    result. Returns ``query_id, rank`` (from 1), ``vec_id, score``; fewer than ``k`` rows
    if there are fewer vectors.
    """
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    base = whole_numbers(vectors, scale)
    width = base.groupBy(F.size("v").alias("w")).count().orderBy(F.desc("count"), "w").first()
    if width is None or width["w"] < 1:
        return empty
    base = base.filter(F.size("v") == width["w"])
    norm = F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c)
    shape = base.agg(F.max(norm).alias("top"), F.count(F.lit(1)).alias("n")).first()
    top = float(shape["top"])
    drawn = base.select("vec_id", "v").orderBy(F.xxhash64("vec_id"), "vec_id").limit(min(SAMPLE, 200 * pivots)).toPandas()
    centres = choose_pivots(_matrix(drawn["v"], width["w"]), pivots)
    # Copies go before any cut to ``k``: they share a block and would push others out of it.
    placed = materialise(base.distinct().mapInPandas(_placer(centres, top), "vec_id long, v array<double>, pivot int, away double"))
    reach = placed.groupBy("pivot").agg(F.min("away").alias("inner"), F.max("away").alias("outer"))
    ring = F.least(F.lit(rings - 1), F.floor(rings * (F.col("away") - F.col("inner")) / F.greatest(F.col("outer") - F.col("inner"), F.lit(1e-9)))).cast("int")
    # At most ``pivots`` rows, and ``pivots * rings`` rings.
    index = placed.join(F.broadcast(reach), "pivot").select("vec_id", "v", "pivot", ring.alias("ring"), "away")
    known = (
        index.groupBy("pivot", "ring").agg(F.min("away").alias("low"), F.max("away").alias("high"), F.count(F.lit(1)).alias("n")).orderBy("pivot", "ring").toPandas()
    )
    blocks = {(p, r): math.ceil(n / BLOCK_ROWS) for p, r, n in zip(known["pivot"], known["ring"], known["n"])}
    many = F.create_map(*[F.lit(x) for (p, r), n in blocks.items() for x in (p * rings + r, n)])
    held = index.select(
        "vec_id", "v", "pivot", "ring",
        F.pmod(F.xxhash64("vec_id"), F.element_at(many, F.col("pivot") * rings + F.col("ring"))).cast("int").alias("block"),
    )
    asked = materialise(whole_numbers(queries, scale).filter(F.size("v") == width["w"]).distinct())
    groups = max(1, math.ceil(asked.count() / BLOCK_QUERIES))

    def visit(asking: DataFrame, first: bool) -> tuple[DataFrame, DataFrame]:
        routes = asking.mapInPandas(
            _router(centres, top, known, k, first, blocks),
            "query_id long, q array<double>, pivot int, ring int, at int, block array<int>",
        )
        spread = routes.select("query_id", "q", "pivot", "ring", F.explode("block").alias("block"), F.pmod(F.xxhash64("query_id"), F.lit(groups)).alias("part"))
        # A ring meets the blocks of queries that visit it, and no others.
        met = spread.select(*[F.col(c).alias(f"{c}_") for c in ("pivot", "ring", "part")]).distinct()
        wide = held.join(met, (F.col("pivot") == F.col("pivot_")) & (F.col("ring") == F.col("ring_"))).select(
            "vec_id", "v", "pivot", "ring", "block", F.col("part_").alias("part")
        )
        key = ["pivot", "ring", "block", "part"]
        hits = spread.groupBy(*key).cogroup(wide.groupBy(*key)).applyInPandas(_scorer(k), HITS)
        return routes.select("query_id", "q", "at"), hits

    def best(hits: DataFrame) -> DataFrame:
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    seen, hits = visit(asked.select("vec_id", "v"), True)
    near = materialise(best(hits))
    floors = near.groupBy("query_id").agg(F.max(F.when(F.col("rank") == k, F.col("score"))).alias("floor"))
    # By vector too: rings seen by one vector of an id are not seen by another.
    been = seen.groupBy("query_id", "q").agg(F.collect_list("at").alias("seen"))
    again = (
        asked.join(floors, asked["vec_id"] == floors["query_id"], "left")
        .drop("query_id")
        .join(been, (asked["vec_id"] == been["query_id"]) & (asked["v"] == been["q"]), "left")
        .select("vec_id", "v", "floor", "seen")
    )
    _, more = visit(again, False)
    return best(more.unionByName(near.select("query_id", "vec_id", "score"))).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
