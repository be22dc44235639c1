"""Document fingerprints: threshold-scaled sketches of character shingles.

A fingerprint holds every shingle hash below a fixed fraction of the hash range and, so
that short texts are not left without any, the ``floor`` smallest hashes. Below its own
limit (the fraction, or the largest hash kept because of the floor) it is complete.
Likeness and containment count the hashes below the smaller of two limits, so texts of
very unequal length can be compared. Fingerprints of parts merge into that of the whole.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlens.llm.textops import FAMILIES, U64, mix, text_bytes, window_hashes

FRACTION_BITS = 5  # one hash of 32 is kept
FLOOR = 64
WIDTH = 8
BUCKET_BYTES = 4 << 20
LIMIT = U64((1 << (64 - FRACTION_BITS)) - 1)

RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, next_contained double"
)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def sketch(points: np.ndarray) -> np.ndarray:
    """Kept hashes, ascending; a text shorter than a shingle is one shingle."""
    if not len(points):
        return np.empty(0, U64)
    units = (points.astype(U64) + U64(1)) * U64(FAMILIES[1])
    units ^= units >> U64(29)
    h = mix(window_hashes(units, min(WIDTH, len(units)), FAMILIES[0]) + U64(min(WIDTH, len(units))))
    low = np.unique(h[h <= LIMIT])
    return low if len(low) >= FLOOR else np.unique(h)[:FLOOR]


def encode(kept: np.ndarray) -> str:
    return base64.b64encode(kept.astype(">u8").tobytes()).decode()


def decode(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), dtype=">u8").astype(U64)


def merge(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Sketch of two texts together."""
    both = np.union1d(one, two)
    low = both[both <= LIMIT]
    return low if len(low) >= FLOOR else both[:FLOOR]


def limit(kept: np.ndarray) -> np.uint64:
    """Largest hash up to which a sketch is complete."""
    if len(kept) < FLOOR:
        return U64(0xFFFFFFFFFFFFFFFF)
    return max(LIMIT, kept[-1])


def compare(one: np.ndarray, two: np.ndarray) -> tuple[float, float]:
    """Likeness, and the share of ``two`` that ``one`` contains; two empty texts are alike."""
    at = min(limit(one), limit(two))
    one, two = one[one <= at], two[two <= at]
    both = len(np.intersect1d(one, two, assume_unique=True))
    whole = len(one) + len(two) - both
    return (both / whole if whole else 1.0), (both / len(two) if len(two) else 1.0)


def _fingerprint(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come sorted by bucket, the first document of the next bucket last."""
    before = None
    for frame in frames:
        rows = []
        for doc_id, text, last in zip(frame["doc_id"].astype("Int64"), frame["text"], frame["last"]):
            points = code_points(text)
            now = (None if doc_id is pd.NA else doc_id, text, points, sketch(points))
            if before is not None:
                rows.append(_row(before, now))
            before = None if last else now
        out = pd.DataFrame(rows, columns=[c.split()[0] for c in RESULT.split(", ")])
        out["doc_id"] = out["doc_id"].astype("Int64")
        yield out


def _row(this, following):
    doc_id, text, points, kept = this
    cut = len(points) // 4
    edited = text[: len(points) - cut] + following[1][:cut]
    edited_kept = sketch(code_points(edited))
    near_next, contained = compare(kept, following[3])
    return (
        doc_id,
        len(points),
        hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
        encode(kept),
        encode(edited_kept),
        compare(kept, edited_kept)[0],
        near_next,
        contained,
    )


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Fingerprint each text and its edited text, compared with the next document.

    The edited text has its last quarter (``floor(n_chars / 4)`` code points) replaced by
    as many first ones of the next document by ``doc_id``, or all if that is shorter; the
    last document is followed by the first. A null text counts as empty; an empty text
    has an empty fingerprint, alike only to another empty one. Rows with equal ``doc_id``
    follow one another by text, and a null ``doc_id`` comes first. Other columns are
    ignored; an empty table gives an empty result. Returns one row per input row.

    Documents are cut into ranges of ids and sorted within them; each range also gets
    the first document of the next one. The cuts, one for 4 MB of text but 20,000 at
    most, and the first id of each range are all that the driver sees.
    """
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    _, size = text_bytes(given)
    parts = min(20_000, max(32, math.ceil(size / BUCKET_BYTES)))
    cuts = sorted({int(x) for x in given.approxQuantile("doc_id", [i / parts for i in range(1, parts)], 1 / (4 * parts))})
    bucket = F.coalesce(_position(cuts, F.col("doc_id")), F.lit(-1)).cast("long").alias("bucket")
    dealt = given.select(bucket, F.lit(False).alias("last"), "doc_id", "text")
    order = sorted((r["bucket"], r["id"]) for r in given.groupBy(bucket).agg(F.min("doc_id").alias("id")).collect())
    if not order:
        return docs.sparkSession.createDataFrame([], RESULT)
    # (bucket, first bucket after it); the last range is followed by the first one.
    turns = [(a[0], b[0], b[1]) for a, b in zip(order, order[1:] + order[:1])]
    heads = docs.sparkSession.createDataFrame(turns, "bucket long, after long, id long")
    follow = (
        dealt.join(F.broadcast(heads), (dealt["bucket"] == heads["after"]) & dealt["doc_id"].eqNullSafe(heads["id"]))
        .groupBy(heads["bucket"])
        .agg(F.min(F.struct("doc_id", "text")).alias("d"))
        .select("bucket", F.lit(True).alias("last"), "d.doc_id", "d.text")
    )
    return (
        dealt.unionByName(follow)
        .repartition("bucket")
        .sortWithinPartitions("bucket", "last", "doc_id", "text")
        .mapInPandas(_fingerprint, RESULT)
    )


def _position(cuts: list[int], value: F.Column) -> F.Column:
    """Number of cuts that are not above the value, by halving; null for null."""
    if not cuts:
        return F.when(value.isNotNull(), 0)
    held, n = F.array(*map(F.lit, cuts)), len(cuts)
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(n.bit_length()))])

    def step(at, width):
        inside = (at + width <= n) & (F.get(held, F.least(at + width, F.lit(n)) - 1) <= value)
        return F.when(inside, at + width).otherwise(at)

    return F.when(value.isNotNull(), F.aggregate(steps, F.lit(0), step))
