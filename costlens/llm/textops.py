"""Words, hashes and sizes shared by the text operators.

Words are runs of bytes other than the six ASCII white-space characters. Hashes
are computed for whole buffers of joined texts at once; they depend on the words
alone, so that every task of a job gives a word the same hash.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

U64 = np.uint64
# Odd multipliers of two independent hash families.
FAMILIES = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> U64(33))
    h = h * U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U64(33))


def _geometric(base: int, n: int) -> np.ndarray:
    """``base ** i`` modulo 2**64 for i below ``n``."""
    out = np.ones(n, dtype=U64)
    done = 1
    while done < n:
        step = min(done, n - done)
        out[done : done + step] = out[:step] * U64(pow(base, done, 1 << 64))
        done += step
    return out


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, at least ``n`` of each."""
    known = _POWERS.get(base)
    if known is None or len(known[0]) < n:
        size = max(n, 1 << 16)
        known = (_geometric(base, size), _geometric(pow(base, -1, 1 << 64), size))
        if size <= 1 << 22:
            _POWERS[base] = known
    return known[0][:n], known[1][:n]


def word_bounds(buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word of a byte buffer."""
    inside = np.zeros(len(buffer) + 2, dtype=bool)
    np.logical_not(_SPACE[buffer], out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[0::2], edges[1::2]


def span_hashes(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Hash of each byte span, equal for equal bytes."""
    if not len(starts):
        return np.empty(0, dtype=U64)
    up, down = powers(base, len(buffer))
    total = np.zeros(len(buffer) + 1, dtype=U64)
    np.cumsum((buffer.astype(U64) + U64(1)) * up, out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(U64))


def codes(values: Iterable) -> tuple[np.ndarray, list]:
    """Number of each value and the distinct values; strings may hold null characters."""
    known: dict = {}
    number = [known.setdefault(v, len(known)) for v in values]
    return np.array(number, dtype=np.int64), list(known)


def ragged_cells(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of all cells of ragged rows, one row after the other."""
    first = np.cumsum(lengths) - lengths
    return np.arange(int(lengths.sum())) + np.repeat(starts - first, lengths)


def distinct_spans(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans of at least one cell that stand for the others, and the number of each span's.

    Spans are told apart by ``hashes`` and then compared cell by cell; one that shares
    the hash of another but not its cells stands for itself.
    """
    _, kept, number = np.unique(hashes, return_index=True, return_inverse=True)
    lengths = ends - starts
    same = lengths == lengths[kept][number]
    if same.any():
        cells, like = (ragged_cells(at[same], lengths[same]) for at in (starts, starts[kept][number]))
        equal = np.logical_and.reduceat(buffer[cells] == buffer[like], np.cumsum(lengths[same]) - lengths[same])
        same[np.flatnonzero(same)[~equal]] = False
    other = np.flatnonzero(~same)
    number[other] = len(kept) + np.arange(len(other))
    return np.concatenate([kept, other]), number


def window_hashes(units: np.ndarray, width: int, base: int) -> np.ndarray:
    """Polynomial hash of every run of ``width`` consecutive unit hashes."""
    if len(units) < width:
        return np.empty(0, dtype=U64)
    out, reach, offset = None, 0, width
    block, size = units, 1
    # Blocks of 1, 2, 4, ... units are added up by the binary digits of the width.
    while offset:
        if offset & 1:
            count = len(units) - (reach + size) + 1
            part = block[reach : reach + count]
            out = part if out is None else out[:count] + U64(pow(base, reach, 1 << 64)) * part
            reach += size
        offset >>= 1
        if offset:
            block = block[:-size] + U64(pow(base, size, 1 << 64)) * block[size:]
            size *= 2
    return out


def batches(texts: Sequence[str | None], limit: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``first, last, buffer, offsets`` of runs of texts of about ``limit`` bytes.

    Text i (null counts as empty) is ``buffer[offsets[i - first] : offsets[i - first + 1]]``
    and ends with a line feed. A longer text makes a run of its own.
    """
    first, held, size = 0, [], 0
    for i, text in enumerate(texts):
        raw = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""
        if held and size + len(raw) > limit:
            yield _batch(first, i, held)
            first, held, size = i, [], 0
        held.append(raw)
        size += len(raw) + 1
    if held:
        yield _batch(first, first + len(held), held)


def _batch(first: int, last: int, held: list[bytes]):
    offsets = np.zeros(len(held) + 1, dtype=np.int64)
    np.cumsum([len(x) + 1 for x in held], out=offsets[1:])
    return first, last, np.frombuffer(b"\n".join(held) + b"\n", dtype=np.uint8), offsets


def text_bytes(docs: DataFrame, column: str = "text") -> tuple[int, int]:
    """Rows of a table and bytes of its texts."""
    row = docs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(column)).alias("b")).first()
    return row["n"], row["b"] or 0
