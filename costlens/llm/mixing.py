"""Mixing sources to target weights, with built-in functions only.

Token weights are raked: the cells of source, language and topic start with their token
counts and are scaled in turn until each marginal meets its target (iterative
proportional fitting). A document is then kept with the probability of its cell, scaled
so that the wanted share of all tokens is expected, decided by a hash of its id and text.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costlens.operators.attach import attach
from costlens.session import materialise

ROUNDS = 12
MOST_ROUNDS, WITHIN = 240, 1e-6  # where raking goes on until marginals are that near, relatively
FILL_ROUNDS = 6
SHARE = 0.9
TASK_CELLS = 100_000
DIMENSIONS = ("source", "lang", "topic")
UNKNOWN = "(none)"
SCALE = 1 << 52

# What tells a topic, tried in this order.
TOPICS = (
    ("legal", r"(?i)licen[sc]e|copyright|all rights reserved"),
    ("table", r"\|[^|\n]*\|[^|\n]*\|"),
    ("contact", r"@[A-Za-z0-9-]+\.|\+[0-9][0-9 ().-]{7,}"),
)
OTHER_TOPIC = "prose"


def topic_of(text: Column) -> Column:
    """Coarse topic by content marks, from the whole text."""
    text = F.coalesce(text, F.lit(""))
    out = F.when(text.rlike(TOPICS[0][1]), TOPICS[0][0])
    for name, pattern in TOPICS[1:]:
        out = out.when(text.rlike(pattern), name)
    return out.otherwise(OTHER_TOPIC)


def tokens_of(text: Column) -> Column:
    """Tokens of a text for weighing: its runs without white space."""
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, r"[\x20\x09-\x0D]++"))).cast("long")


def described(docs: DataFrame, *own: Column) -> DataFrame:
    """The three dimensions, the tokens and the draw of each document, beside ``own``."""
    text = F.col("text").cast("string")
    return docs.select(
        *own,
        F.coalesce(F.col("source").cast("string"), F.lit(UNKNOWN)).alias("source"),
        F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"),
        topic_of(text).alias("topic"),
        tokens_of(text).alias("tokens"),
        draw(F.col("doc_id"), text).alias("draw"),
    )


def even_targets(cells: DataFrame, dimension: str, power: float = 0.5) -> DataFrame:
    """Target shares of one dimension: its token shares to a power, made to add up to 1."""
    mass = cells.groupBy(dimension).agg(F.sum("tokens").alias("t"))
    powered = mass.select(dimension, F.pow(F.col("t").cast("double"), F.lit(power)).alias("p"))
    whole = Window.partitionBy(F.lit(1))
    return powered.select(dimension, (F.col("p") / F.sum("p").over(whole)).alias("target"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], rounds: int = ROUNDS, within: float | None = None) -> DataFrame:
    """``cells`` with a raked ``weight``, whose marginals come near the targets.

    ``cells`` has the dimensions and ``tokens``, one row per cell; a table of targets has
    a dimension's levels and ``target``. A level without a target keeps no weight; a
    target without tokens cannot be met. Cells are few (levels of three attributes), so
    every round is a chain of small windows, cut by a checkpoint. With ``within``, rounds
    go on until each marginal is that near its target, relatively; targets that do not
    settle raise ValueError.
    """
    out = cells.filter("tokens > 0").withColumn("weight", F.col("tokens").cast("double"))
    for name, target in targets.items():
        out = out.join(target.withColumnRenamed("target", f"target_{name}"), name)
    # So few rows run in one task, where windows need no exchange.
    tasks = max(1, math.ceil(cells.count() / TASK_CELLS))
    out = materialise(out.coalesce(tasks))
    for turn in range(rounds if within is None else MOST_ROUNDS):
        for name in targets:
            level = Window.partitionBy(name)
            out = out.withColumn("weight", F.col("weight") * F.col(f"target_{name}") / F.sum("weight").over(level))
        if turn % 4 == 3:
            out = materialise(out)
            if within is not None and _settled(out, targets, within):
                return out
    if within is not None:
        raise ValueError(f"marginals do not settle within {within} in {MOST_ROUNDS} rounds")
    return out


def _settled(raked: DataFrame, targets: dict[str, DataFrame], within: float) -> bool:
    off = [F.abs(F.sum("weight").over(Window.partitionBy(d)) - F.col(f"target_{d}")) - within * F.col(f"target_{d}") for d in targets]
    worst = raked.select(F.greatest(*off, F.lit(-1.0)).alias("off")).agg(F.max("off")).first()[0]
    return worst is None or worst <= 0


def full_share(raked: DataFrame) -> float:
    """The largest share of tokens at which no chance exceeds 1, so that all weights are met."""
    row = raked.agg(F.sum("weight").alias("w"), F.sum("tokens").alias("t"), F.max(F.col("weight") / F.col("tokens")).alias("most")).first()
    return float(row["w"] / (row["t"] * row["most"])) if row["most"] else SHARE


def chances(cells: DataFrame, share: float, rounds: int = FILL_ROUNDS) -> DataFrame:
    """Chance of keeping a document of each cell.

    In proportion to weight over tokens, at most 1, so that ``share`` of all tokens is
    expected: what cells that are kept whole cannot give is taken from the others, a
    round at a time.
    """
    whole = Window.partitionBy(F.lit(1))
    out = cells.withColumn("fair", F.col("weight") / F.col("tokens") * F.sum("tokens").over(whole) * F.lit(share) / F.sum("weight").over(whole))
    for _ in range(rounds):
        full, part = F.col("fair") >= 1, F.col("fair") * F.col("tokens")
        left = F.sum("tokens").over(whole) * F.lit(share) - F.sum(F.when(full, F.col("tokens")).otherwise(0)).over(whole)
        open_ = F.sum(F.when(full, 0.0).otherwise(part)).over(whole)
        out = out.withColumn("fair", F.when(full | (open_ <= 0), F.col("fair")).otherwise(F.col("fair") * F.greatest(left, F.lit(0.0)) / open_))
    return out.withColumn("chance", F.least(F.lit(1.0), "fair")).drop("fair")


def draw(doc_id: Column, text: Column) -> Column:
    """Number from 0 to 1 that depends on a document's id and text alone."""
    key = F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("long") / F.lit(float(SCALE))


def mix_sources(docs: DataFrame, targets: dict[str, DataFrame] | None = None, share: float | None = SHARE, rounds: int = ROUNDS) -> DataFrame:
    """Sample documents by calibrated probabilities; see ``rake`` and ``chances``.

    Adds ``tokens, topic_class, weight, chance`` and ``kept`` to ``doc_id``; one row per
    input row. A null source or language is a level of its own. A text without tokens is
    in no cell and is not kept. Equal rows share their fate. Without ``targets`` each
    marginal is drawn half-way (on a log scale) towards equal shares.

    A large ``share`` misses targets: cells that should grow cannot give more than all
    their documents. Without a ``share`` (None) the largest one is taken at which every
    cell meets its weight, and raking goes on until the marginals settle; it may be small,
    as one rare cell bounds it. ``marginals`` tells what a share reaches.
    """
    named = described(docs, F.col("doc_id"))
    return _fitted(named, targets, share, rounds).select(
        "doc_id",
        "tokens",
        F.col("topic").alias("topic_class"),
        F.coalesce("weight", F.lit(0.0)).alias("weight"),
        F.coalesce("chance", F.lit(0.0)).alias("chance"),
        _kept().alias("kept"),
    )


def _fitted(named: DataFrame, targets: dict[str, DataFrame] | None, share: float | None, rounds: int) -> DataFrame:
    """Described documents with the weight and chance of their cells."""
    cells = materialise(named.groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens")))
    goals = targets or {d: even_targets(cells, d) for d in DIMENSIONS}
    raked = rake(cells, goals, rounds, WITHIN if share is None else None)
    share = full_share(raked) if share is None else share
    return attach(named, chances(raked, share).select(*DIMENSIONS, "weight", "chance"), DIMENSIONS)


def _kept() -> Column:
    return (F.col("tokens") > 0) & (F.col("draw") < F.coalesce("chance", F.lit(0.0)))


def marginals(docs: DataFrame, targets: dict[str, DataFrame] | None = None, share: float | None = SHARE) -> DataFrame:
    """``dimension, level, wanted, expected, reached``: token shares of each level.

    ``wanted`` is the target, ``expected`` what the chances give on average and
    ``reached`` what the sample holds.
    """
    named = materialise(described(docs, F.col("doc_id")))
    goals = targets or {d: even_targets(materialise(named.groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens"))), d) for d in DIMENSIONS}
    tokens, chance = F.col("tokens"), F.coalesce("chance", F.lit(0.0))
    cells = _fitted(named, goals, share, ROUNDS).groupBy(*DIMENSIONS).agg(
        F.sum(tokens * chance).alias("e"), F.sum(F.when(_kept(), tokens).otherwise(0)).cast("double").alias("r")
    )
    cells, whole, out = materialise(cells), Window.partitionBy(F.lit(1)), None
    for d, goal in goals.items():
        level = cells.groupBy(d).agg(F.sum("e").alias("e"), F.sum("r").alias("r"))
        level = level.select(d, *[F.try_divide(c, F.sum(c).over(whole)).alias(c) for c in ("e", "r")])
        part = level.join(goal, d).select(
            F.lit(d).alias("dimension"), F.col(d).alias("level"), F.col("target").alias("wanted"), F.col("e").alias("expected"), F.col("r").alias("reached")
        )
        out = part if out is None else out.unionByName(part)
    return out


def sample_mixture(docs: DataFrame, targets: dict[str, DataFrame] | None = None, share: float | None = SHARE) -> DataFrame:
    """The documents that ``mix_sources`` keeps, with their own columns."""
    names = docs.columns
    named = described(docs, F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))
    return _fitted(named, targets, share, ROUNDS).filter(_kept()).select("row.*")
