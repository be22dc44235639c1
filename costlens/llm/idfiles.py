"""Token-id files: whole texts as ids, in ascending document order.

A shard file holds, all little-endian:

    magic ``IDS2``, number of documents and of blocks (u32), crc32 of the tables (u32)
    tables: doc_id (i64), whether it is null (u8) and number of ids (u64) per document;
            ids, bytes and crc32 (u32 each) per block
    the coded blocks one after another

A shard has whole documents; a block has up to 2048 consecutive ids of the shard and is
coded from a fresh state (see ``coder``), so a damaged block harms no other. Files are
named by range and turn, ``part-000012-000003.ids``; names ascend with the documents.
"""

from __future__ import annotations

import math
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from costlens.llm import coder
from costlens.llm.textops import text_bytes
from costlens.llm.tokens import encoder
from costlens.session import materialise

MAGIC = b"IDS2"
SHARD_IDS = coder.BLOCK * 2048  # more blocks a call cost less time each
RANGE_BYTES = 9 << 20  # of text, whose ids make one shard as a rule
SLICE = 200

MANIFEST = "part int, turn int, n_docs long, n_ids long, n_bytes long"
ROWS = "part int, turn int, doc_id long, before long, n_tokens long, ids_crc32 long"


def write_shard(doc_ids: list, sizes: list[int], ids: np.ndarray) -> bytes:
    """One shard as bytes; ``ids`` of all documents, ``sizes`` of them each."""
    n = math.ceil(len(ids) / coder.BLOCK)
    grid = np.zeros(n * coder.BLOCK, dtype=np.int64)
    grid[: len(ids)] = ids
    if len(ids) and grid.max() >= 1 << coder.ID_BITS:
        raise ValueError("ids must be below 65536")
    lengths = np.full(n, coder.BLOCK, dtype=np.int64)
    if n:
        lengths[-1] = len(ids) - (n - 1) * coder.BLOCK
    blocks = coder.encode(grid.reshape(n, coder.BLOCK), lengths) if n else []
    tables = b"".join(
        [
            np.array([0 if d is None else d for d in doc_ids], dtype="<i8").tobytes(),
            np.array([d is None for d in doc_ids], dtype="u1").tobytes(),
            np.array(sizes, dtype="<u8").tobytes(),
            lengths.astype("<u4").tobytes(),
            np.array([len(b) for b in blocks], dtype="<u4").tobytes(),
            np.array([zlib.crc32(b) for b in blocks], dtype="<u4").tobytes(),
        ]
    )
    return b"".join([MAGIC, struct.pack("<III", len(doc_ids), n, zlib.crc32(tables)), tables, *blocks])


def read_shard(raw: bytes) -> tuple[list, np.ndarray, np.ndarray]:
    """``doc_ids, sizes, ids`` of a shard; a damaged one raises ``ValueError``."""
    if raw[:4] != MAGIC:
        raise ValueError("not a token-id shard")
    docs, n, check = struct.unpack_from("<III", raw, 4)
    end = 16 + docs * 17 + n * 12
    if zlib.crc32(raw[16:end]) != check:
        raise ValueError("damaged tables")
    at = 16

    def column(kind: str, count: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(raw, dtype=kind, count=count, offset=at)
        at += out.nbytes
        return out

    doc_ids, null, sizes = column("<i8", docs), column("u1", docs), column("<u8", docs)
    lengths, held, crc = column("<u4", n), column("<u4", n), column("<u4", n)
    cuts = end + np.concatenate([[0], np.cumsum(held.astype(np.int64))])
    blocks = [raw[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
    bad = [i for i, (b, c) in enumerate(zip(blocks, crc)) if zlib.crc32(b) != c]
    if bad:
        raise ValueError(f"damaged blocks {bad[:10]}")
    ids = coder.decode(blocks, lengths.astype(np.int64)) if n else np.empty((0, coder.BLOCK), np.int64)
    flat = ids[np.arange(ids.shape[1]) < lengths[:, None]]
    return [None if z else int(d) for d, z in zip(doc_ids, null)], sizes.astype(np.int64), flat.astype("<u4")


def _writer(folder: str, tokenizer: str, rule: str, end: int):
    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        place, base = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
        task = TaskContext.get()
        part, turn = task.partitionId(), 0
        encode = encoder(tokenizer, rule)
        doc_ids, sizes, held, n = [], [], [], 0

        def flush():
            nonlocal doc_ids, sizes, held, n, turn
            raw = write_shard(doc_ids, sizes, np.concatenate(held))
            name = f"{base}/part-{part:06d}-{turn:06d}.ids"
            # Only a whole file gets the name; an attempt that runs again replaces it.
            with place.open_output_stream(f"{name}.{task.taskAttemptId()}") as out:
                out.write(raw)
            place.move(f"{name}.{task.taskAttemptId()}", name)
            row = (part, turn, len(doc_ids), n, len(raw))
            doc_ids, sizes, held, n, turn = [], [], [], 0, turn + 1
            return pd.DataFrame([row], columns=["part", "turn", "n_docs", "n_ids", "n_bytes"])

        place.create_dir(base, recursive=True)
        for frame in frames:
            for a in range(0, len(frame), SLICE):
                some = frame.iloc[a : a + SLICE]
                ids, offsets = encode([t if isinstance(t, str) else "" for t in some["text"]])
                for doc_id, x, y in zip(some["doc_id"].astype("Int64"), offsets[:-1], offsets[1:]):
                    doc_ids.append(None if doc_id is pd.NA else int(doc_id))
                    sizes.append(int(y - x) + 1)
                    held.append(np.append(ids[x:y], np.uint32(end)))
                    n += sizes[-1]
                    if n >= SHARD_IDS:
                        yield flush()
        if doc_ids:
            yield flush()

    return write


def write_token_ids(docs: DataFrame, folder: str, tokenizer: str, rule: str = "word", end: int = 2) -> DataFrame:
    """Write the ids of each whole text, and the id ``end``, in ascending ``doc_id`` order.

    ``folder`` must be new and shared by all executors. A null text counts as empty.
    Rows without ``doc_id`` come first; rows that repeat one are ordered by text. Returns
    one row per shard file: ``part, turn, n_docs, n_ids, n_bytes``.
    """
    _, size = text_bytes(docs)
    ranges = max(8, math.ceil(size / RANGE_BYTES))
    return materialise(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .repartitionByRange(ranges, F.asc_nulls_first("doc_id"))
        .sortWithinPartitions(F.asc_nulls_first("doc_id"), F.asc_nulls_first("text"))
        .mapInPandas(_writer(folder, tokenizer, rule, end), MANIFEST)
    )


def _read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for part, turn, raw in zip(frame["part"], frame["turn"], frame["content"]):
            doc_ids, sizes, ids = read_shard(raw)
            ends = np.cumsum(sizes)
            crc = [zlib.crc32(ids[b - n : b].tobytes()) for b, n in zip(ends, sizes)]
            out = pd.DataFrame({"part": part, "turn": turn, "doc_id": pd.array(doc_ids, dtype="Int64"), "before": ends - sizes, "n_tokens": sizes, "ids_crc32": crc})
            yield out.astype({"part": "int32", "turn": "int32", "ids_crc32": "int64"})


def read_token_ids(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """Read the files of a folder back: ``doc_id, start, n_tokens, ids_crc32``.

    ``start`` counts the ids of all documents before it. The ids are decoded whole and
    checked; a damaged file raises.
    """
    name = r"part-(\d+)-(\d+)\.ids$"
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.ids")
        .load(folder)
        .select(F.regexp_extract("path", name, 1).cast("int").alias("part"), F.regexp_extract("path", name, 2).cast("int").alias("turn"), "content")
    )
    # One row per range of documents passes the window without a key.
    ahead = manifest.groupBy("part").agg(F.sum("n_ids").alias("n")).select(
        "part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("first")
    )
    inside = Window.partitionBy("part").orderBy("turn")
    base = manifest.withColumn("within", F.sum("n_ids").over(inside) - F.col("n_ids")).join(ahead, "part")
    return (
        files.mapInPandas(_read, ROWS)
        .join(base.select("part", "turn", (F.col("first") + F.col("within")).alias("base")), ["part", "turn"])
        .select("doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
    )
