"""Counts of 64-bit hashes, shuffled in few bytes a hash.

Tasks add up some millions of hashes at a time, cut them to their first 40 bits and
write them in order, as differences; hashes that agree in these bits are counted as one,
so a count may be too large and never too small. Ranges of hashes are added up in
tasks of their own.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from costlens.llm.textops import U64

KEY_BITS = 40
HELD = 1 << 20  # hashes added up before they are written
RANGE_BYTES = 1 << 23  # of text whose hashes make a range
PACKED = "range long, keys binary, counts binary"
TOTALS = "key long, n long"


def varints(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers in groups of seven bits, lowest first, and the end of each."""
    sizes = np.ones(len(values), dtype=np.int64)
    for k in range(1, 10):
        more = values >= U64(1 << 7 * k)
        if not more.any():
            break
        sizes += more
    ends = np.cumsum(sizes)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, dtype=np.uint8)
    at = ends - sizes
    for k in range(int(sizes.max(initial=0))):
        has = np.flatnonzero(sizes > k)
        out[at[has] + k] = ((values[has] >> U64(7 * k)) & U64(127)) | (U64(128) * (sizes[has] > k + 1).astype(U64))
    return out, ends


def read_varints(raw: np.ndarray) -> np.ndarray:
    ends = np.flatnonzero(raw < 128)
    starts = np.append(0, ends[:-1] + 1)[: len(ends)]
    sizes = ends - starts + 1
    out = np.zeros(len(ends), dtype=U64)
    for k in range(int(sizes.max(initial=0))):
        has = np.flatnonzero(sizes > k)
        out[has] |= (raw[starts[has] + k] & np.uint8(127)).astype(U64) << U64(7 * k)
    return out


def added(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their counts."""
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    return keys[first], np.add.reduceat(n[order], first) if len(first) else n[:0]


def range_bits(size: int) -> int:
    """Bits that tell the ranges for so many bytes of text."""
    return min(KEY_BITS - 8, max(0, math.ceil(size / RANGE_BYTES) - 1).bit_length())


def pack(parts: Iterable[tuple[np.ndarray, np.ndarray]], bits: int) -> Iterator[pd.DataFrame]:
    """Rows of ``PACKED`` for parts of hashes and their counts."""

    def packed():
        keys, n = added(*(np.concatenate(x) for x in zip(*held)))
        place = keys >> U64(KEY_BITS - bits)
        starts = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
        step = np.diff(keys, prepend=U64(0))
        step[starts] = keys[starts] & U64((1 << (KEY_BITS - bits)) - 1)
        columns = {"range": place[starts].astype(np.int64)}
        for name, values in (("keys", step), ("counts", n.astype(U64))):
            raw, ends = varints(values)
            raw, cuts = raw.tobytes(), [0, *ends[starts[1:] - 1].tolist(), int(ends[-1])]
            columns[name] = [raw[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
        return pd.DataFrame(columns)

    held, size = [], 0
    for keys, n in parts:
        held.append((keys >> U64(64 - KEY_BITS), n))
        size += len(keys)
        if size >= HELD:
            yield packed()
            held, size = [], 0
    if size:
        yield packed()


def unpack(place: int, frame: pd.DataFrame, bits: int, least: int) -> pd.DataFrame:
    """``key, n`` of the hashes of one range that are counted ``least`` times."""
    raw = [np.frombuffer(b"".join(frame[c]), dtype=np.uint8) for c in ("keys", "counts")]
    total = np.cumsum(read_varints(raw[0]))
    # Steps begin anew in each row.
    sizes = np.array([len(x) for x in frame["keys"]], dtype=np.int64)
    ends = np.cumsum(np.add.reduceat(raw[0] < 128, np.cumsum(sizes) - sizes, dtype=np.int64))
    base = np.append(U64(0), total[ends[:-1] - 1])
    keys, n = added(total - np.repeat(base, np.diff(ends, prepend=0)), read_varints(raw[1]).astype(np.int64))
    keys, n = keys[n >= least], n[n >= least]
    keys = (keys | U64(place << (KEY_BITS - bits))) << U64(64 - KEY_BITS)
    return pd.DataFrame({"key": keys.view(np.int64), "n": n})


def frequent(packed: DataFrame, bits: int, least: int) -> DataFrame:
    """``key, n`` of the hashes, cut to their first bits, that are counted ``least`` times."""
    return packed.groupBy("range").applyInPandas(lambda place, frame: unpack(int(place[0]), frame, bits, least), TOTALS)
