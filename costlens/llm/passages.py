"""Removal of passages that occurred earlier in the corpus.

Documents are dealt into buckets by a hash of their id. Every bucket sketches its
windows of consecutive words: for each row of a count-min sketch, the slots that its
windows fall into, counted up to two. The sketches of all buckets are merged slot by
slot, a range of slots per group; a merged counter never falls below the true count.
Each bucket gets back those of its own slots that were counted twice or more, so
nothing is broadcast and the sketch widens with the corpus. Windows whose counter is
two or more in every row are then grouped exactly, by a 96-bit hash of their words,
and all but the earliest are removed. A repeated window always has counters of two or
more, hence none is lost.

A passage that a third of all documents share puts one row per bucket, not per
document, into its group: a bucket removes its own later copies beforehand.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from costlens.llm.textops import FAMILIES, U64, batches, mix, span_hashes, text_bytes, window_hashes, word_bounds

BUCKET_BYTES = 8 << 20
SEGMENT_BITS = 24
ESCAPE = 0xFFF
BUCKET_ROWS = 200_000
RUN = (1 << 12) - 1  # windows of one removed run

SKETCH = "depth int, segment long, bucket long, slots binary"
# A span is a row's position in its bucket (20 bits), a start (31) and a number of
# windows (12). Runs that are removed already have no second hash.
FOUND = "h1 long, h2 int, doc_id long, span long"
RESULT = "doc_id long, n_words long, n_removed long, kept_text string, kept_sha256 string"


def pack(values: np.ndarray) -> bytes:
    """Ascending values as 12-bit steps, two in three bytes; a step of 4095 continues."""
    steps = np.diff(values.astype(np.int64), prepend=0)
    long, rest = np.divmod(steps, ESCAPE)
    size = int(long.sum()) + len(steps)
    out = np.full(size + size % 2, ESCAPE, dtype=np.uint32)
    out[np.cumsum(long + 1) - 1] = rest
    pair = out[0::2] | out[1::2] << 12
    return pair.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3].tobytes()


def unpack(raw: bytes) -> np.ndarray:
    wide = np.zeros((len(raw) // 3, 4), dtype=np.uint8)
    wide[:, :3] = np.frombuffer(raw, dtype=np.uint8).reshape(-1, 3)
    pair = wide.view("<u4").ravel()
    steps = np.empty(2 * len(pair), dtype=np.int64)
    steps[0::2], steps[1::2] = pair & 0xFFF, pair >> 12
    return np.cumsum(steps)[steps != ESCAPE]


def slots(h: np.ndarray, row: int, bits: int) -> np.ndarray:
    """Slot of each window hash in one row of the sketch."""
    return (mix(h + U64(row * 0x9E3779B97F4A7C15 % (1 << 64))) >> U64(64 - bits)).astype(np.int64)


def spans(pos: np.ndarray, start: np.ndarray, n) -> np.ndarray:
    return pos << 43 | start << 12 | n


def in_order(group: pd.DataFrame) -> pd.DataFrame:
    """Rows of a bucket by doc_id, then text; the order gives each row its position."""
    return group.sort_values(["doc_id", "text"], kind="stable", na_position="first", ignore_index=True)


def windows(texts: pd.Series, width: int):
    """``position, start, h1, h2`` of every window of the texts, in order."""
    pos, start, one, two = [], [], [], []
    for first, _, buffer, offsets in batches(texts):
        s, e = word_bounds(buffer)
        if len(s) < width:
            continue
        doc = np.searchsorted(offsets, s, side="right") - 1
        last = len(s) - width + 1
        whole = np.flatnonzero(doc[:last] == doc[width - 1 :])
        begin = np.searchsorted(doc, np.arange(len(offsets)))
        h = [window_hashes(span_hashes(buffer, s, e, base), width, base)[whole] for base in FAMILIES]
        pos.append((doc[whole] + first).astype(np.int32))
        start.append((whole - begin[doc[whole]]).astype(np.int32))
        one.append(mix(h[0]))
        two.append(mix(h[1]))
    if not pos:
        return np.empty(0, np.int32), np.empty(0, np.int32), np.empty(0, U64), np.empty(0, U64)
    return tuple(map(np.concatenate, (pos, start, one, two)))


def _sketcher(width: int, depth: int, bits: int):
    def sketch(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        h = windows(in_order(group)["text"], width)[2]
        rows = []
        for row in range(depth):
            at, n = np.unique(slots(h, row, bits), return_counts=True)
            at = np.repeat(at, np.minimum(n, 2))
            segment = at >> SEGMENT_BITS
            cuts = np.flatnonzero(np.diff(segment, prepend=-1))
            for a, b in zip(cuts, [*cuts[1:], len(at)]):
                rows.append((row, int(segment[a]), key[0], pack(at[a:b] & ((1 << SEGMENT_BITS) - 1))))
        return pd.DataFrame(rows, columns=["depth", "segment", "bucket", "slots"])

    return sketch


def merge(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    """Adds up the counters of one range of slots and answers each bucket."""
    parts = [unpack(x) for x in group["slots"]]
    at, n = np.unique(np.concatenate(parts), return_counts=True)
    twice = np.zeros(1 << SEGMENT_BITS, dtype=bool)
    twice[at[n > 1]] = True
    answers = [np.unique(x[twice[x]]) for x in parts]
    rows = [(key[0], key[1], b, pack(x)) for b, x in zip(group["bucket"], answers) if len(x)]
    return pd.DataFrame(rows, columns=["depth", "segment", "bucket", "slots"])


def _finder(width: int, depth: int, bits: int):
    def find(docs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        docs = in_order(docs)
        pos, start, one, two = windows(docs["text"], width)
        for row in range(depth):
            own = answers[answers["depth"] == row].sort_values("segment")
            known = [unpack(x) + (s << SEGMENT_BITS) for s, x in zip(own["segment"], own["slots"])]
            known = np.concatenate(known) if known else np.empty(0, np.int64)
            at = slots(one, row, bits)
            hit = np.zeros(len(at), dtype=bool)
            if len(known):
                hit = known[np.minimum(np.searchsorted(known, at), len(known) - 1)] == at
            pos, start, one, two = pos[hit], start[hit], one[hit], two[hit]
        two = (two >> U64(32)).astype(np.uint32)
        order = np.lexsort((np.arange(len(one)), two, one))
        a, b = one[order], two[order]
        later = np.zeros(len(one), dtype=bool)
        later[order[1:]] = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
        # Windows removed here and now travel as runs under a key of their own.
        pos, start = pos.astype(np.int64), start.astype(np.int64)
        p, s = pos[later], start[later]
        fresh = (np.diff(p, prepend=-1) != 0) | (np.diff(s, prepend=-2) != 1)
        begin = np.maximum.accumulate(np.where(fresh, np.arange(len(p)), 0))
        head = np.flatnonzero((np.arange(len(p)) - begin) % RUN == 0)
        n = np.diff(np.append(head, len(p)))
        ids = pd.array(docs["doc_id"], dtype="Int64")
        firsts = pd.DataFrame({"h1": one[~later].view(np.int64), "h2": two[~later].view(np.int32), "doc_id": ids[pos[~later]], "span": spans(pos[~later], start[~later], 1)})
        runs = pd.DataFrame({"h1": mix(p[head].astype(U64) << U64(32) | s[head].astype(U64)).view(np.int64), "h2": None, "doc_id": ids[p[head]], "span": spans(p[head], s[head], n)})
        return pd.concat([firsts.astype({"h2": "Int32"}), runs.astype({"h2": "Int32"})], ignore_index=True)

    return find


def _cutter(width: int, texts: bool):
    def cut(docs: pd.DataFrame, removed: pd.DataFrame) -> pd.DataFrame:
        docs = in_order(docs)
        span = np.sort(removed["span"].to_numpy(dtype=np.int64))
        cuts = np.searchsorted(span >> 43, np.arange(len(docs) + 1))
        rows = []
        for i, (doc_id, text) in enumerate(zip(docs["doc_id"], docs["text"])):
            words = text.encode("utf-8", "surrogatepass").split() if isinstance(text, str) else []
            total, gone = len(words), 0
            own = span[cuts[i] : cuts[i + 1]]
            if len(own):
                edge = np.zeros(total + 1, dtype=np.int64)
                start, n = own >> 12 & 0x7FFFFFFF, own & RUN
                np.add.at(edge, start, 1)
                np.add.at(edge, start + n + width - 1, -1)
                covered = np.cumsum(edge[:-1]) > 0
                gone = int(covered.sum())
                words = [w for w, c in zip(words, covered.tolist()) if not c]
            kept = b" ".join(words)
            rows.append((doc_id, total, gone, kept.decode("utf-8", "surrogatepass") if texts else None, hashlib.sha256(kept).hexdigest()))
        out = pd.DataFrame(rows, columns=["doc_id", "n_words", "n_removed", "kept_text", "kept_sha256"])
        out["doc_id"] = out["doc_id"].astype("Int64")
        return out

    return cut


def remove_repeats(docs: DataFrame, width: int = 20, depth: int = 2, slots_per_word: int = 4, texts: bool = True) -> DataFrame:
    """Remove words covered by a window of ``width`` words that also starts earlier.

    Earlier means a smaller ``doc_id``, or an earlier start in the same document.
    Windows are judged on the input. A null or empty text has no words; a text
    shorter than the window keeps all. Rows with equal ``doc_id`` are separate
    documents, ordered by text; a null ``doc_id`` counts as the smallest. Other
    columns are ignored; an empty table gives an empty result. Returns ``doc_id,
    n_words, n_removed, kept_text`` (null unless ``texts``) and ``kept_sha256``,
    one row per input row.
    """
    if width < 1 or depth < 1:
        raise ValueError("width and depth must be positive")
    rows, size = text_bytes(docs)
    buckets = max(32, math.ceil(size / BUCKET_BYTES), math.ceil(rows / BUCKET_ROWS))
    bits = max(SEGMENT_BITS + 2, math.ceil(math.log2(slots_per_word * max(1, size / 6))))
    bucket = F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(buckets)).alias("bucket")
    dealt = docs.select(bucket, F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    sketches = dealt.groupBy("bucket").applyInPandas(_sketcher(width, depth, bits), SKETCH)
    answers = sketches.groupBy("depth", "segment").applyInPandas(merge, SKETCH)
    found = dealt.groupBy("bucket").cogroup(answers.groupBy("bucket")).applyInPandas(_finder(width, depth, bits), FOUND)
    same = Window.partitionBy("h1", "h2").orderBy("doc_id", "span")
    removed = found.withColumn("turn", F.row_number().over(same)).filter("h2 IS NULL OR turn > 1").select(bucket, "span")
    return dealt.groupBy("bucket").cogroup(removed.groupBy("bucket")).applyInPandas(_cutter(width, texts), RESULT)
