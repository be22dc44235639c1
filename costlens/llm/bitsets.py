"""Sets of hashes as bits: of bounded size, never missing a member."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costlens.llm.textops import U64

MOST_BITS = 27  # 16 MB


class Bits:
    """A set of 64-bit hashes, one bit each; the first bits of a hash are its place."""

    def __init__(self, bits: int = 3, words: np.ndarray | None = None):
        self.bits = bits
        self.bytes = np.zeros(1 << (bits - 3), dtype=np.uint8) if words is None else words.view(np.uint8)

    def __contains__(self, key: int) -> bool:
        return bool(self.has(np.array([key], dtype=U64))[0])

    def has(self, keys: np.ndarray) -> np.ndarray:
        place = keys >> U64(64 - self.bits)
        return ((self.bytes[place >> U64(3)] >> (place & U64(7)).astype(np.uint8)) & 1).astype(bool)


def gather(keys: DataFrame, most: int = MOST_BITS, n: int | None = None) -> tuple[Bits, int]:
    """The bits of ``key`` and the number of rows (counted unless given); at most
    ``2**most`` bits reach the driver."""
    n = keys.count() if n is None else n
    bits = min(most, max(16, (16 * n).bit_length()))
    place = F.shiftrightunsigned("key", 64 - bits)
    words = keys.groupBy(F.shiftright(place, 6).alias("at")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int"))).alias("word"))
    found = words.toPandas() if n else pd.DataFrame({"at": [], "word": []})
    held = np.zeros(1 << (bits - 6), dtype="<i8")
    held[found["at"].to_numpy(np.int64)] = found["word"].to_numpy(np.int64)
    return Bits(bits, held), n


def held(keys: DataFrame) -> Broadcast:
    """Broadcast bits of ``key``. A hash that is no member passes with a chance of one in
    128 at most, while there are fewer than ``2**MOST_BITS`` bits."""
    return keys.sparkSession.sparkContext.broadcast(gather(keys, n=8 * keys.count())[0])


def membership(keys: DataFrame) -> Callable[[Column], Column]:
    """Test of a column of hashes against the rows of ``key``; it never misses a member."""
    sets = held(keys)

    @F.pandas_udf("boolean")
    def may(values: pd.Series) -> pd.Series:
        return pd.Series(sets.value.has(values.to_numpy(np.int64).view(U64)))

    return may


def joined(one: Bits, two: Bits) -> Bits:
    """Both sets; the smaller one's bits stand for all places that begin with them."""
    small, large = sorted((one, two), key=lambda b: b.bits)
    spread = np.repeat(np.unpackbits(small.bytes, bitorder="little"), 1 << (large.bits - small.bits))
    return Bits(large.bits, np.packbits(spread, bitorder="little") | large.bytes)
