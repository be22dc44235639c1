"""Near-duplicate documents by a multi-index join over min-hash signatures.

A document's signature is a row of 8-bit symbols, one min-hash each. Its chunks are runs
of six symbols; two signatures that differ in at most ``chunks * (errors + 1) - 1`` of
these differ in at most ``errors`` symbols of some chunk (pigeonhole). Every way of
leaving out that many symbols of a chunk makes a key, so all pairs below this distance
share a key; with 12 chunks and one error it is 23 of 72. A pair at a similarity of 0.8
shares none with a chance of 3 in a million. Pairs of a key whose whole signatures differ
in more than ``DISTANCE`` of 144 symbols (4.5 deviations above the mean at 0.8) are put
aside; all others are confirmed on the full shingle sets.

Pairs of a key are never written out whole. In star rounds each document is compared
with one document of its keys that lies in another component; after that nearly all
linked documents share a component and need no comparison. Of pairs that still cross
components, those of small keys (256 documents at most) are compared inside the tasks that
hold the keys, and a near pair comes out of the first key it shares alone. Documents of large keys are cut into blocks
of the largest key they have, each pair of blocks that meet in a key travels once with
its sets, and only links come out.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from costlens.llm.bitsets import held
from costlens.llm.components import connected_components
from costlens.llm.textops import FAMILIES, U64, batches, mix, span_hashes, window_hashes, word_bounds
from costlens.session import materialise

LONGS, CHUNKS, CHUNK, ERRORS = 18, 12, 6, 1  # 8 symbols a long; a chunk lies in one
HELD_SYMBOLS = list(itertools.combinations(range(CHUNK), CHUNK - ERRORS))  # of a chunk, by key
SYMBOLS, SYMBOL_BITS = 8 * LONGS, 8
DISTANCE = 50
STAR_ROUNDS = 2
LARGE_KEY, BLOCK = 256, 256
TASK_ROWS, TASK_SETS = 100_000, 4_000  # of one task, where a table has become small
TASK_BUCKETS = 20  # of keys; the documents of a bucket are compared together
SLICE = 256  # texts whose sets a worker holds at once


def shingle_sets(texts, width: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text, A-Z in lower case.

    A text with fewer words than ``width`` has its word sequence as its only shingle;
    one without words has none.
    """
    for _, _, buffer, offsets in batches(texts):
        lower = np.where((buffer >= 65) & (buffer <= 90), buffer + 32, buffer).astype(np.uint8)
        starts, ends = word_bounds(lower)
        words = span_hashes(lower, starts, ends, FAMILIES[0])
        shingles = mix(window_hashes(words, width, FAMILIES[1]))
        cut = np.searchsorted(starts, offsets)
        for a, b in zip(cut[:-1], cut[1:]):
            if b - a >= width:
                yield np.unique(shingles[a : b - width + 1])
            elif b > a:
                yield mix(window_hashes(words[a:b], int(b - a), FAMILIES[1]) + U64(b - a))
            else:
                yield np.empty(0, U64)


def signatures(sets: list[np.ndarray], symbols: int) -> np.ndarray:
    """Min-hash symbols of non-empty sets, one row each."""
    seeds = mix(np.arange(1, 2 * symbols + 1, dtype=U64))
    flat = np.concatenate(sets)
    at = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]]).astype(np.int64)
    out = np.empty((len(sets), symbols), dtype=np.uint8)
    for k in range(symbols):
        least = np.minimum.reduceat((flat ^ seeds[2 * k]) * (seeds[2 * k + 1] | U64(1)), at)
        out[:, k] = mix(least) >> U64(64 - SYMBOL_BITS)
    return out


def _slices(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for at in range(0, len(frame), SLICE):
            yield frame.iloc[at : at + SLICE]


def _sketcher(width: int):
    def sketch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in _slices(frames):
            sets = list(shingle_sets(frame["text"], width))
            full = [i for i, s in enumerate(sets) if len(s)]
            digest, signature = [None] * len(sets), [None] * len(sets)
            if full:
                for i, row in zip(full, signatures([sets[i] for i in full], SYMBOLS).view(np.int64)):
                    digest[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest()
                    signature[i] = row
            doc_id = frame["doc_id"].astype("Int64").reset_index(drop=True)
            yield pd.DataFrame({"doc_id": doc_id, "n_shingles": [len(s) for s in sets], "digest": digest, "signature": signature})

    return sketch


def _set_maker(width: int, wanted: Broadcast):
    """Sets of the texts whose ``key`` may be wanted."""

    def make(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in _slices(frame[wanted.value.has(frame["key"].to_numpy(np.int64).view(U64))] for frame in frames):
            yield pd.DataFrame({"id": frame["doc_id"].to_numpy(), "shingles": [s.tobytes() for s in shingle_sets(frame["text"], width)]})

    return make


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def _confirmer(percent: int):
    def confirm(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            keep = [_similar(np.frombuffer(x, U64), np.frombuffer(y, U64), percent) for x, y in zip(frame["x"], frame["y"])]
            yield frame.loc[np.array(keep, dtype=bool), ["a", "b"]]

    return confirm


def _block_linker(percent: int):
    def link(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        links = []
        if len(left) and len(right):
            other = np.stack(right["signature"].to_list()).astype(np.int64).view(np.uint8)
            ids, n, component = (right[c].to_numpy() for c in ("id", "n", "component"))
            sets = [np.frombuffer(x, U64) for x in right["shingles"]]
            for i, size, part, own, raw in zip(left["id"], left["n"], left["component"], left["signature"], left["shingles"]):
                apart = (other != np.asarray(own, dtype=np.int64).view(np.uint8)).sum(axis=1)
                close = (component != part) & (apart <= DISTANCE) & (100 * np.minimum(n, size) >= percent * np.maximum(n, size))
                mine = np.frombuffer(raw, U64)
                links += [(min(i, ids[j]), max(i, ids[j])) for j in np.flatnonzero(close) if _similar(mine, sets[j], percent)]
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return link


def first_slots(apart: np.ndarray) -> np.ndarray:
    """Place, from 1, of the first key that two signatures share; ``apart`` tells their symbols apart."""
    chunks = apart[:, : 8 * CHUNKS].reshape(len(apart), CHUNKS, 8)
    shared = np.stack([~chunks[:, :, list(held)].any(axis=2) for held in HELD_SYMBOLS], axis=2)
    return shared.reshape(len(apart), CHUNKS * len(HELD_SYMBOLS)).argmax(axis=1) + 1


def _near_pairs(percent: int, once: bool = False):
    """Pairs of ids across components that share a key, with near signatures.

    Rows of a bucket are sorted by key and compared ``d`` places apart for all keys at
    once, so memory follows the rows and the pairs that are near. With ``once`` a pair is
    found in the first of all keys it shares alone; ``slot`` is the place of the key.
    """

    def find(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("key", ignore_index=True)
        key, ids, n, component = (frame[c].to_numpy(np.int64) for c in ("key", "id", "n", "component"))
        marks = np.stack(frame["signature"].to_list()).astype(np.int64).view(np.uint8)
        end = np.searchsorted(key, key, side="right")
        left, d, found = np.arange(len(key)), 0, [np.empty((0, 2), np.int64)]
        while True:
            d += 1
            left = left[left + d < end[left]]
            if not len(left):
                break
            right = left + d
            open_ = (component[left] != component[right]) & (100 * np.minimum(n[left], n[right]) >= percent * np.maximum(n[left], n[right]))
            x, y = left[open_], right[open_]
            apart = marks[x] != marks[y]
            near = apart.sum(axis=1) <= DISTANCE
            if once:
                near[near] = frame["slot"].to_numpy()[x[near]] == first_slots(apart[near])
            found.append(np.sort(np.column_stack([ids[x[near]], ids[y[near]]]), axis=1))
        return pd.DataFrame(np.unique(np.concatenate(found), axis=0), columns=["a", "b"])

    return find


def _key_list(signature) -> F.Column:
    """Keys of a signature in turn: each chunk with each choice of ``ERRORS`` symbols left out."""
    masks = [sum(0xFF << 8 * i for i in held) for held in HELD_SYMBOLS]
    each = F.transform(
        F.sequence(F.lit(0), F.lit(CHUNKS - 1)),
        lambda c: F.transform(F.array(*map(F.lit, masks)), lambda m: F.xxhash64(c, m, F.get(signature, c).bitwiseAND(m))),
    )
    return F.flatten(each)


def _keys(signature) -> F.Column:
    return F.explode(_key_list(signature))


def shared_keys(classes: DataFrame) -> DataFrame:
    """``key, id, n`` of every key that classes of several ids have.

    Keys are made and shuffled once. Nearly all of them are unique, so adding them up in
    tasks before the shuffle would only fill memory.
    """
    keyed = classes.select(_keys(F.col("signature")).alias("key"), "id", "n")
    same = Window.partitionBy("key")
    met = keyed.select("*", F.min("id").over(same).alias("lo"), F.max("id").over(same).alias("hi")).filter("lo < hi")
    return met.select("key", "id", "n").distinct()


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Group documents linked by word-shingle similarity of ``percent`` or more.

    Returns ``doc_id, n_shingles, component_id, kept``, one row per input row.
    ``component_id`` is the smallest ``doc_id`` reachable over links and ``kept`` marks
    the row that bears it. Null, empty and blank texts have no shingles, are linked with
    nothing and are kept. Equal sets are linked. Rows that repeat a ``doc_id`` count as
    one document. A row without ``doc_id`` joins no group: its component is null and it
    is kept. Other columns are ignored; an empty table gives an empty result.
    """
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = materialise(given.mapInPandas(_sketcher(width), "doc_id long, n_shingles long, digest binary, signature array<long>"))
    classes = materialise(
        rows.filter("digest IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"), F.first("signature").alias("signature"))
    )
    members = materialise(shared_keys(classes))
    # A small table runs in few tasks from here on; a large one in as many as before.
    tasks = max(1, math.ceil(members.count() / TASK_ROWS))
    members = members.coalesce(tasks)
    involved = materialise(members.select(F.col("id").alias("doc_id")).distinct().coalesce(tasks))
    # Texts stay where they are: a set more, of an id that only shares its bit, is joined with nothing.
    wanted = held(involved.select(F.xxhash64("doc_id").alias("key")))
    named = given.filter("doc_id IS NOT NULL").withColumn("key", F.xxhash64("doc_id"))
    sets = materialise(named.mapInPandas(_set_maker(width, wanted), "id long, shingles binary"))

    def confirmed(pairs: DataFrame) -> DataFrame:
        x = sets.select(F.col("id").alias("a"), F.col("shingles").alias("x"))
        y = sets.select(F.col("id").alias("b"), F.col("shingles").alias("y"))
        return pairs.join(y, "b").coalesce(set_tasks).join(x, "a").coalesce(set_tasks).mapInPandas(_confirmer(percent), "a long, b long")

    def joined(links: DataFrame) -> DataFrame:
        """Component of each class that shares a key."""
        return materialise(
            nodes.join(connected_components(links), "id", "left").select("id", F.coalesce("component", "id").alias("component")).coalesce(tasks)
        )

    nodes = involved.select(F.col("doc_id").alias("id"))
    set_tasks = max(1, math.ceil(sets.count() / TASK_SETS))
    sets = sets.coalesce(set_tasks)
    parts, links = nodes.select("id", F.col("id").alias("component")), None
    for turn in range(STAR_ROUNDS):
        placed = members.join(parts, "id").coalesce(tasks)
        rank = F.col("id") if turn == 0 else F.xxhash64("id", F.lit(turn))
        centres = (
            placed.groupBy("key")
            .agg(F.min(F.struct(rank.alias("rank"), "id", "n", "component")).alias("centre"), F.min("component").alias("lo"), F.max("component").alias("hi"))
            .filter("lo < hi")
            .select("key", "centre")
            .coalesce(tasks)
        )
        pairs = (
            placed.join(centres, "key")
            .filter(f"component <> centre.component AND 100 * least(n, centre.n) >= {percent} * greatest(n, centre.n)")
            .coalesce(tasks)
            .groupBy("id")
            .agg(F.min(F.struct("centre.rank", "centre.id")).alias("centre"))
            .select(F.least("id", "centre.id").alias("a"), F.greatest("id", "centre.id").alias("b"))
            .coalesce(tasks)
            .distinct()
            .coalesce(tasks)
        )
        found = materialise(confirmed(pairs))
        links = found if links is None else links.unionByName(found)
        parts = joined(links)

    placed = members.join(parts, "id").coalesce(tasks)
    crossing = (
        placed.groupBy("key")
        .agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("size"))
        .filter("lo < hi")
        .select("key", "size")
        .coalesce(tasks)
    )
    open_ = materialise(placed.join(crossing, "key").coalesce(tasks))
    marks = classes.select("id", "signature")
    bucket = F.pmod(F.xxhash64("key"), F.lit(tasks * TASK_BUCKETS)).alias("bucket")
    small = open_.filter(F.col("size") <= LARGE_KEY).join(marks, "id").select(
        bucket, "key", "id", "n", "component", "signature", F.array_position(_key_list(F.col("signature")), F.col("key")).alias("slot")
    )
    near = small.groupBy("bucket").applyInPandas(_near_pairs(percent, once=True), "a long, b long").distinct().coalesce(tasks)
    links = links.unionByName(materialise(confirmed(near))).unionByName(materialise(_large_links(open_, sets, marks, percent, tasks, set_tasks)))
    parts = joined(links)
    ids = classes.select("digest", "id").join(parts, "id", "left").select("digest", F.coalesce("component", "id").alias("component_id"))
    return rows.join(ids, "digest", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("component_id", "doc_id"), F.lit(True)).alias("kept"),
    )


def _large_links(members: DataFrame, sets: DataFrame, marks: DataFrame, percent: int, tasks: int, set_tasks: int) -> DataFrame:
    """Links across components between documents that share a large key."""
    large = members.filter(F.col("size") > LARGE_KEY).select("key", "id", "n", "component", "size")
    home = large.groupBy("id", "n", "component").agg(F.max(F.struct("size", "key")).alias("home")).coalesce(tasks)
    held = home.groupBy(F.col("home.key").alias("home_key")).agg(F.count(F.lit(1)).alias("held"))
    cut = home.join(held, F.col("home.key") == F.col("home_key")).select(
        "id", "n", "component", F.struct("home_key", F.pmod(F.xxhash64("id"), F.ceil(F.col("held") / BLOCK)).alias("part")).alias("block")
    )
    cut = materialise(cut.coalesce(tasks))
    met = large.select("key", "id").join(cut.select("id", "block"), "id").select("key", "block").coalesce(tasks).distinct().coalesce(tasks)
    pairs = (
        met.select("key", F.col("block").alias("x"))
        .join(met.select("key", F.col("block").alias("y")), "key")
        .filter("x <= y")
        .select("x", "y")
        .coalesce(tasks)
        .distinct()
        .coalesce(tasks)
    )
    full = cut.join(sets, "id").coalesce(set_tasks).join(marks, "id").coalesce(set_tasks)
    # Every column is named anew: both sides come from one frame.
    columns = ("id", "n", "component", "signature", "shingles")
    sides = [
        pairs.join(full, pairs[side] == full["block"]).select(
            F.xxhash64("x", "y").alias("pair"), *[F.col(c).alias(f"{c}_{side}") for c in columns]
        )
        for side in ("x", "y")
    ]
    sides = [s.select(F.col("pair").alias("pair"), *[F.col(f"{c}_{n}").alias(c) for c in columns]) for s, n in zip(sides, "xy")]
    return sides[0].groupBy("pair").cogroup(sides[1].groupBy("pair")).applyInPandas(_block_linker(percent), "a long, b long")
