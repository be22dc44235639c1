"""Packing of token sequences by multiway differencing.

Each document is tokenised where it is read. Whole windows of it are sequences of their
own; what is left is cut into pieces of one size and a last one of any size, which
evens windows out. Groups of pieces, dealt by a hash, are then
divided over windows: every piece starts as a partial partition with one filled window,
and the two partial partitions of the largest imbalance are merged, the fullest window
of one with the emptiest of the other, until one is left. If a window overflows, the
group is divided anew over more windows. Only piece sizes are shuffled, never ids.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlens.llm.textops import text_bytes
from costlens.llm.tokens import encoder

PIECE_TOKENS = 256
GROUP_PIECES = 1500
SLICE = 200  # texts tokenised together

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def difference(sizes: np.ndarray, windows: int) -> np.ndarray:
    """Window of each size, after multiway differencing over ``windows`` windows."""
    if windows < 1:
        raise ValueError("at least one window")
    n = len(sizes)
    # Node i < n is a size; a later node joins two. A partial partition lists its
    # non-empty windows, fullest first, as sums and nodes.
    joined: list[tuple[int, int]] = []
    heap = [(-int(s), i, np.array([s], dtype=np.int64), np.array([i])) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    turn = n
    while len(heap) > 1:
        _, _, sums, nodes = heapq.heappop(heap)
        _, _, others, their = heapq.heappop(heap)
        over = len(sums) + len(others) - windows
        if over > 0:
            # The emptiest windows of one meet the fullest of the other.
            base = n + len(joined)
            joined.extend(zip(nodes[-over:].tolist(), their[-over:][::-1].tolist()))
            met = sums[-over:] + others[-over:][::-1]
            sums = np.concatenate([sums[:-over], others[:-over], met])
            nodes = np.concatenate([nodes[:-over], their[:-over], np.arange(base, base + over)])
        else:
            sums, nodes = np.concatenate([sums, others]), np.concatenate([nodes, their])
        order = np.argsort(-sums, kind="stable")
        sums, nodes = sums[order], nodes[order]
        least = sums[-1] if len(sums) == windows else 0
        heapq.heappush(heap, (int(least - sums[0]), turn, sums, nodes))
        turn += 1
    out = np.empty(n, dtype=np.int64)
    if heap:
        place = np.empty(n + len(joined), dtype=np.int64)
        place[heap[0][3]] = np.arange(len(heap[0][3]))
        for i in range(len(joined) - 1, -1, -1):
            a, b = joined[i]
            place[a] = place[b] = place[n + i]
        out[:] = place[:n]
    return out


def divide(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Windows that hold at most ``capacity``, as few as differencing finds."""
    count = max(1, math.ceil(int(sizes.sum()) / capacity))
    while True:
        at = difference(sizes, count)
        if np.bincount(at, weights=sizes, minlength=1).max(initial=0) <= capacity:
            return at
        count += max(1, count // 200)


def _cutter(path: str, rule: str, end: int, capacity: int, piece: int):
    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(path, rule)
        for frame in frames:
            for a in range(0, len(frame), SLICE):
                part = frame.iloc[a : a + SLICE]
                ids, offsets = encode([t if isinstance(t, str) else "" for t in part["text"]])
                rows = []
                for doc_id, x, y in zip(part["doc_id"].astype("Int64"), offsets[:-1], offsets[1:]):
                    own = np.append(ids[x:y], np.uint32(end)).astype("<u4")
                    whole = len(own) // capacity * capacity
                    cuts = [*range(0, whole, capacity), *range(whole, len(own), piece), len(own)]
                    for s, e in zip(cuts[:-1], cuts[1:]):
                        rows.append((doc_id, s, e - s, zlib.crc32(own[s:e].tobytes()), len(own)))
                out = pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
                out["doc_id"] = out["doc_id"].astype("Int64")
                yield out

    return cut


def _packer(capacity: int):
    def pack(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True], kind="stable", ignore_index=True)
        length = group["length"].to_numpy()
        full = int((length == capacity).sum())
        at = np.concatenate([np.arange(full), full + divide(length[full:], capacity)]) if full < len(length) else np.arange(full)
        order = np.argsort(at, kind="stable")
        before = np.cumsum(length[order]) - length[order]
        first = np.flatnonzero(np.diff(at[order], prepend=-1))
        offset = np.empty(len(at), dtype=np.int64)
        offset[order] = before - np.repeat(before[first], np.diff(np.append(first, len(at))))
        return group.drop(columns="part").assign(sequence_id=(int(key[0]) << 32) + at, offset=offset)

    return pack


def pack_documents(
    docs: DataFrame, tokenizer: str, rule: str = "byte", end: int = 1, capacity: int = 2048, piece: int = PIECE_TOKENS
) -> DataFrame:
    """Pack the token ids of all documents into sequences of ``capacity`` tokens.

    A document's tokens are the ids of its whole text (null: empty) and the id ``end``.
    Returns one row per piece: ``doc_id, start`` (tokens of the document before it),
    ``length, ids_crc32`` (of the ids as little-endian unsigned 32-bit integers),
    ``doc_tokens, sequence_id, offset`` (tokens of the sequence before it, without
    gaps). An empty text is one piece, the end id. Repeated rows and rows without
    ``doc_id`` are packed like any other. Other columns are ignored; an empty table
    gives an empty result. ``tokenizer`` is a file that executors can read.
    """
    if not 1 <= piece <= capacity:
        raise ValueError("piece must lie between 1 and capacity")
    n, size = text_bytes(docs)
    groups = max(1, math.ceil((n + size / (2 * piece)) / GROUP_PIECES))
    pieces = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInPandas(
        _cutter(tokenizer, rule, end, capacity, piece), PIECES
    )
    part = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(groups)).alias("part")
    return (
        pieces.select("*", part).groupBy("part").applyInPandas(_packer(capacity), PIECES + ", sequence_id long, offset long")
    )
