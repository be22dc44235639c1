"""Audit of how far the sources of a language differ in their terms, by chunk factorization.

Texts are only split at white space. Chunks are counted in each document and added up by
language and source; each distinct chunk of a language is tokenized once.
A document that holds a term in several chunks counts once: the chunk counts bound the
number of documents from both sides, and only terms which these bounds leave open are
looked up in the documents again.

Term rates are whole numbers of parts in a thousand million. The divergence of two groups
is summed over all kept terms, but terms that one of them lacks all have the same rate
there; so these are summed by distinct count, and only terms that two groups share are
visited pair by pair, in blocks of terms.
"""

from __future__ import annotations

import collections
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from costlens.llm.bitsets import gather
from costlens.llm.textops import FAMILIES, U64, batches, codes, mix, ragged_cells, span_hashes, word_bounds
from costlens.session import scratch_path

TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
CHUNK = re.compile(r"[^\x09-\x0D\x20]+")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_DOCUMENTS = 10
TOP = 10
BROADCAST_ROWS = 100_000  # terms that are sent to every task; more are shuffled
BATCH = 1 << 19  # bytes of text counted at once
HELD = 1 << 23  # bytes of text added up before their counts are written
RANGE_BYTES = 1 << 24  # of text whose chunks make a range of hashes
LONG = 1 << 22  # code points from which a text is counted on its own
SPANS = 1 << 16  # spans gathered at once
FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=U64)  # masks of the first bytes
PACKED = "place long, forms binary, sizes binary, code binary, docs binary, n binary, gids binary, lids binary"
CHUNKS = "chunk string, lid long, docs long, gids array<long>, ns array<long>"
BLOCK_ROWS = 100_000  # counts of the groups in one block of terms


def same_before(buffer: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether each byte span equals the one before it, compared eight bytes at a time."""
    out = np.append(False, sizes[1:] == sizes[:-1])[: len(sizes)]
    held = np.append(buffer, np.zeros(8, dtype=np.uint8))
    eight = np.ndarray((len(buffer) + 1,), "<u8", held, strides=(1,))
    at, done = np.flatnonzero(out), 0
    while len(at) and done < 64:
        other = (eight[starts[at] + done] ^ eight[starts[at - 1] + done]) & FIRST[np.minimum(sizes[at] - done, 8)]
        out[at[other != 0]] = False
        done += 8
        at = at[(other == 0) & (sizes[at] > done)]
    if len(at):
        cells, like = (ragged_cells(starts[x] + done, sizes[at] - done) for x in (at, at - 1))
        out[at] = np.logical_and.reduceat(buffer[cells] == buffer[like], np.cumsum(sizes[at] - done) - (sizes[at] - done))
    return out


def in_order(buffer: np.ndarray, starts: np.ndarray, sizes: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order in which equal spans follow each other as given, and ``same_before`` in it.

    It is by the first bits of the hash. Where two different spans share these, equal ones
    may lie apart; they then make two chunks, and sums and bounds stay right.
    """
    bits = U64(max(1, len(hashes).bit_length()))
    key = hashes >> bits << bits | np.arange(len(hashes), dtype=U64)
    key.sort()
    order = (key & ((U64(1) << bits) - U64(1))).astype(np.int64)
    return order, same_before(buffer, starts[order], sizes[order])


def changed(values: np.ndarray) -> np.ndarray:
    return np.append(True, values[1:] != values[:-1])[: len(values)]


class Words:
    """The chunks of a batch of texts: spans of ``buffer``, in the order of the texts.

    Span i is in text ``doc[i]`` and counts ``n[i]`` times (once, if ``n`` is None).
    """

    def __init__(self, buffer, starts, ends, doc, n=None):
        self.buffer, self.starts, self.sizes, self.doc, self.n = buffer, starts, ends - starts, doc, n
        self.hashes = span_hashes(buffer, starts, ends, FAMILIES[0])

    def counted(self, group: np.ndarray):
        """``starts, sizes, hashes, group, docs, n`` of each chunk in each group of texts.

        Texts must come in the order of their groups.
        """
        order, same = in_order(self.buffer, self.starts, self.sizes, self.hashes)
        doc = self.doc[order]
        of = group[doc]
        first = ~same | changed(of)
        at = np.flatnonzero(first)
        docs = np.add.reduceat(first | changed(doc), at, dtype=np.int64)
        n = np.diff(np.append(at, len(order))) if self.n is None else np.add.reduceat(self.n[order], at)
        return (*(x[order[at]] for x in (self.starts, self.sizes, self.hashes)), of[at], docs, n)


def joined_forms(forms: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buffer, starts and ends of some strings."""
    raw = [x.encode("utf-8", "surrogatepass") for x in forms]
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    ends = np.cumsum(sizes)
    return np.frombuffer(b"".join(raw), dtype=np.uint8), ends - sizes, ends


def chunk_hashes(forms: list[str]) -> np.ndarray:
    return span_hashes(*joined_forms(forms), FAMILIES[0])


def read_chunks(texts: list[str]) -> Iterator[Words]:
    """The chunks of texts in the order given; those of a very long text are added up first."""
    first = 0
    for i in [*(i for i, t in enumerate(texts) if len(t) > LONG), len(texts)]:
        for a, _, buffer, offsets in batches(texts[first:i], BATCH):
            starts, ends = word_bounds(buffer)
            if len(starts):
                held = np.diff(np.searchsorted(starts, offsets))
                yield Words(buffer, starts, ends, first + a + np.repeat(np.arange(len(held)), held))
        if i < len(texts):
            found = collections.Counter(m[0] for m in CHUNK.finditer(texts[i]))
            if found:
                yield Words(*joined_forms(list(found)), np.full(len(found), i), np.fromiter(found.values(), np.int64, len(found)))
        first = i + 1


def gathered(buffer: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> bytes:
    """The bytes of spans, one after the other."""
    cuts = range(0, len(starts), SPANS)
    return b"".join(buffer[ragged_cells(starts[i : i + SPANS], sizes[i : i + SPANS])].tobytes() for i in cuts)


def joined_hashes(buffer: np.ndarray, ends: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Hashes of spans that lie one after the other, about ``BATCH`` bytes at once."""
    cuts = np.unique(np.append(np.searchsorted(ends, np.arange(0, len(buffer), BATCH)), len(ends))).tolist()
    out = np.empty(len(ends), dtype=U64)
    for a, b in zip(cuts[:-1], cuts[1:]):
        first = int(ends[a] - sizes[a])
        out[a:b] = span_hashes(buffer[first : int(ends[b - 1])], ends[a:b] - sizes[a:b] - first, ends[a:b] - first, FAMILIES[0])
    return out


def small(values: np.ndarray) -> bytes:
    """Whole numbers from 0 in as few bytes each as the largest needs."""
    width = next(w for w in (1, 2, 4, 8) if w == 8 or int(values.max(initial=0)) < 1 << 8 * w)
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def wide(raw: list[bytes]) -> np.ndarray:
    return np.concatenate([np.frombuffer(x, dtype=f"<u{x[0]}", offset=1).astype(np.int64) for x in raw])


def count_chunks(bits: int):
    """Documents and occurrences of each chunk by group, packed by ranges of the hash."""

    def added(held, gids, lids):
        size = np.cumsum([0, *(len(x[0]) for x in held)])
        buffer = np.concatenate([x[0] for x in held])
        starts, sizes, hashes, group, docs, n = (np.concatenate(x) for x in zip(*(x[1:] for x in held)))
        starts = starts + np.repeat(size[:-1], [len(x[1]) for x in held])
        order, same = in_order(buffer, starts, sizes, hashes)
        at = np.flatnonzero(~same | changed(group[order]))
        docs, n = (np.add.reduceat(x[order], at) for x in (docs, n))
        order = order[at]
        starts, sizes, hashes, group = (x[order] for x in (starts, sizes, hashes, group))
        forms = gathered(buffer, starts, sizes)
        place = (hashes >> U64(64 - bits)).astype(np.int64)
        cuts = np.append(np.flatnonzero(changed(place)), len(place))
        ends = np.append(0, np.cumsum(sizes))
        rows = []
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            known, code = np.unique(group[a:b], return_inverse=True)
            rows.append((int(place[a]), forms[ends[a] : ends[b]], *(small(x) for x in (sizes[a:b], code, docs[a:b], n[a:b])), gids[known].tobytes(), lids[known].tobytes()))
        return pd.DataFrame(rows, columns=["place", "forms", "sizes", "code", "docs", "n", "gids", "lids"])

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            gids, first, group = np.unique(frame["gid"].to_numpy(np.int64), return_index=True, return_inverse=True)
            lids = frame["lid"].to_numpy(np.int64)[first]
            order = np.argsort(group, kind="stable")
            group, texts = group[order], frame["text"].to_numpy(object)[order].tolist()
            held, size, frame = [], 0, None
            for words in read_chunks(texts):
                held.append((words.buffer, *words.counted(group)))
                size += len(words.buffer)
                if size >= HELD:
                    yield added(held, gids, lids)
                    held, size = [], 0
            if held:
                yield added(held, gids, lids)

    return count


def add_chunks(table: pa.Table) -> pa.Table:
    """One row for each chunk of a range and language, with the groups that hold it."""
    column = {c: table.column(c).to_pylist() for c in table.column_names}
    buffer = np.frombuffer(b"".join(column["forms"]), dtype=np.uint8)
    sizes, code, docs, n = (wide(column[c]) for c in ("sizes", "code", "docs", "n"))
    ends = np.cumsum(sizes)
    # Groups by language, numbered in that order over all rows.
    gids, lids = (np.frombuffer(b"".join(column[c]), dtype=np.int64) for c in ("gids", "lids"))
    _, first, number = np.unique(np.stack([lids, gids], axis=1), axis=0, return_index=True, return_inverse=True)
    known = np.array([len(x) // 8 for x in column["gids"]])
    base = np.repeat(np.cumsum(known) - known, [(len(x) - 1) // x[0] for x in column["code"]])
    group = number.reshape(-1)[base + code]
    gids, lids = gids[first], lids[first]
    by_group = np.argsort(group, kind="stable")
    starts, hashes = ends - sizes, joined_hashes(buffer, ends, sizes)
    starts, sizes, hashes, docs, n, group = (x[by_group] for x in (starts, sizes, hashes, docs, n, group))
    order, same = in_order(buffer, starts, sizes, hashes)
    group = group[order]
    at = np.flatnonzero(~same | changed(group))
    row = np.flatnonzero((~same | changed(lids[group]))[at])
    docs, n = (np.add.reduceat(x[order], at) for x in (docs, n))
    group, kept = group[at], order[at[row]]
    text_ends = np.append(0, np.cumsum(sizes[kept]))
    forms = pa.LargeStringArray.from_buffers(len(kept), pa.py_buffer(text_ends), pa.py_buffer(gathered(buffer, starts[kept], sizes[kept]))).cast(pa.string())
    cuts = pa.array(np.append(row, len(at)), pa.int32())
    lists = [pa.ListArray.from_arrays(cuts, pa.array(x)) for x in (gids[group], n)]
    return pa.table([forms, pa.array(lids[group[row]]), pa.array(np.add.reduceat(docs, row)), *lists], names=["chunk", "lid", "docs", "gids", "ns"])


def chunk_table(docs: DataFrame, size: int) -> DataFrame:
    """One row for each distinct chunk of a language: its ``terms`` in turn, the documents
    that hold it, and the groups ``gids`` where it occurs ``ns`` times.

    The terms are found here, once for each chunk.
    """
    bits = max(1, math.ceil(size / RANGE_BYTES).bit_length())
    packed = docs.select("gid", "lid", "text").mapInPandas(count_chunks(bits), PACKED)
    rows = packed.groupBy("place").applyInArrow(add_chunks, CHUNKS)
    return rows.withColumn("terms", F.regexp_extract_all(F.translate("chunk", UPPER, LOWER), F.lit(TERM), F.lit(0))).filter(F.size("terms") > 0)


def salted(hashes: np.ndarray, lang: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each chunk in its language."""
    key = mix(hashes ^ mix(lang.view(U64)))
    return key, mix(key ^ U64(FAMILIES[1]))


def with_keys(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        key, check = salted(chunk_hashes(frame["chunk"].tolist()), frame["lid"].to_numpy(np.int64))
        yield pd.DataFrame({"key": key.view(np.int64), "check": check.view(np.int64)})


def open_documents(docs: DataFrame, chunks: DataFrame) -> DataFrame:
    """``lid, doc, copy, chunk`` for each row of ``docs`` and chunk of ``chunks`` (``lid,
    chunk``) in it; some other chunks come along. Two sets of bits, 16 MB at most each,
    keep most others from being written."""
    keys = stored(chunks.mapInPandas(with_keys, "key long, check long"), "keys")
    n = 8 * keys.count()
    sets = docs.sparkSession.sparkContext.broadcast([gather(keys.select(F.col(c).alias("key")), n=n)[0] for c in ("key", "check")])

    def look_up(frames):
        for frame in frames:
            lids, doc, copy = (frame[c].to_numpy(np.int64) for c in ("lid", "doc", "copy"))
            for words in read_chunks(frame["text"].tolist()):
                key, check = salted(words.hashes, lids[words.doc])
                hit = np.flatnonzero(sets.value[0].has(key))
                hit = hit[sets.value[1].has(check[hit])]
                raw = words.buffer.tobytes()
                found = dict.fromkeys((d, raw[a : a + b]) for d, a, b in zip(words.doc[hit].tolist(), words.starts[hit].tolist(), words.sizes[hit].tolist()))
                own = np.array([d for d, _ in found], dtype=np.int64)
                yield pd.DataFrame({"lid": lids[own], "doc": doc[own], "copy": copy[own], "chunk": strings([x.decode("utf-8", "surrogatepass") for _, x in found])})

    return docs.select("lid", "doc", "copy", "text").mapInPandas(look_up, "lid long, doc long, copy long, chunk string")


def strings(values: list[str]) -> pd.Series:
    return pd.Series(values, dtype=object)


def term_counts(docs: DataFrame, size: int, least: int, broadcast_rows: int) -> DataFrame:
    """``gid, lid, term, count`` of terms in at least ``least`` documents of the language.

    ``docs`` has ``text`` (``size`` bytes in all), hashes ``lid`` of the language and
    ``gid`` of the group, and ``doc, copy``, two hashes of the row.

    A term's documents number at least those of its commonest chunk and at most those of
    all its chunks together (a chunk that holds it twice counts twice there). A second
    scan notes which documents hold the chunks of terms that the bounds leave open, each
    of them in few documents. The occurrences by group come with the chunks.
    """
    table = stored(chunk_table(docs, size), "chunks")
    found = table.select("lid", "chunk", "docs", F.explode("terms").alias("term"))
    bounds = stored(found.groupBy("lid", "term").agg(F.max("docs").alias("low"), F.sum("docs").alias("high")).filter(F.col("high") >= least), "bounds")

    def side(rows: DataFrame) -> DataFrame:
        return F.broadcast(rows) if rows.count() <= broadcast_rows else rows

    unsure = side(bounds.filter(F.col("low") < least).select("lid", "term"))
    open_chunks = stored(found.select("lid", "chunk", "term").distinct().join(unsure, ["lid", "term"]), "open")
    seen = open_documents(docs, open_chunks.select("lid", "chunk").distinct()).join(side(open_chunks), ["lid", "chunk"])
    # Equal rows share both hashes; each of them brings its own copy of every chunk.
    copies = seen.groupBy("lid", "doc", "copy", "term", "chunk").agg(F.count(F.lit(1)).alias("docs"))
    of_doc = copies.groupBy("lid", "doc", "copy", "term").agg(F.max("docs").alias("docs"))
    exact = of_doc.groupBy("lid", "term").agg(F.sum("docs").alias("docs")).filter(F.col("docs") >= least)
    kept = stored(bounds.filter(F.col("low") >= least).select("lid", "term").unionByName(exact.select("lid", "term")), "kept")
    held = table.select("lid", F.explode("terms").alias("term"), "gids", "ns").join(side(kept), ["lid", "term"])
    counts = held.select("lid", "term", F.inline(F.arrays_zip("gids", "ns")).alias("gid", "n"))
    return counts.groupBy("gid", "lid", "term").agg(F.sum("n").alias("count"))


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows as a table in the shared folder, far smaller than a checkpoint of them."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def rate(count, total):
    """``1 + floor(1e9 * (count + 2) / total)`` in whole numbers, three digits at a time."""
    left, out = count + F.lit(2), F.lit(0).cast("long")
    for _ in range(3):
        left = left * F.lit(1000)
        out = out * F.lit(1000) + F.call_function("div", left, total)
        left = left % total
    return F.lit(1) + out


def gap(p, q):
    """``floor((p - q)**2 / (p + q))``; rates are below 2**31, so nothing overflows."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def _gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _added(keys: list[np.ndarray], values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, where = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.zeros(len(key), dtype=np.int64)
    np.add.at(total, where, np.concatenate(values))
    return key, total


def shared_terms(frame: pd.DataFrame) -> pd.DataFrame:
    """What the terms that two groups share add to their divergence, for one block of terms.

    Rows are sorted by term; rows ``d`` places apart are compared for all terms at once,
    so memory follows the rows and the pairs of groups, never the pairs of rows.
    """
    group = frame["group"].to_numpy(np.int64)
    groups, place = np.unique(group, return_inverse=True)
    term, _ = codes(zip(frame["lid"].tolist(), frame["term"]))
    order = np.lexsort((place, term))
    term, place = term[order], place[order]
    p, none = frame["p"].to_numpy(np.int64)[order], frame["p0"].to_numpy(np.int64)[order]
    end = np.searchsorted(term, term, side="right")
    left, d, keys, values, held = np.arange(len(term)), 0, [], [], 0
    while True:
        d += 1
        left = left[left + d < end[left]]
        if not len(left):
            break
        right = left + d
        more = _gap(p[left], p[right]) - _gap(p[left], none[right]) - _gap(none[left], p[right]) + _gap(none[left], none[right])
        keys.append(place[left] * len(groups) + place[right])
        values.append(more)
        held += len(left)
        if held > 1 << 22:
            key, total = _added(keys, values)
            keys, values, held = [key], [total], len(key)
    if not keys:
        return pd.DataFrame({"group": [], "other": [], "value": []}, dtype="int64")
    key, total = _added(keys, values)
    one, two = groups[key // len(groups)], groups[key % len(groups)]
    return pd.DataFrame({"group": np.append(one, two), "other": np.append(two, one), "value": np.append(total, total)})


def audit_sources(docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Divergence of each source of a language from the others, and its own terms.

    A term is a run of letters (ASCII letters, lowered, and all characters beyond ASCII);
    a language keeps the terms in at least ``least`` of its documents. Each row counts as
    a document, repeated rows and rows without ``doc_id`` too. A null text, ``lang`` or
    ``source`` reads as the empty string, so it makes a group of its own. Texts are used
    whole whatever their length. Other columns are ignored. An empty table gives an empty
    result; a language without kept terms has pairs of value 0 and no terms.

    Part ``pair`` has one row for each other source of the language, part ``term`` the
    ``top`` terms more frequent in the source than in the language. Ties rank by ``item``
    in byte order. Counts stay exact while a group has fewer than 9e15 term occurrences.
    The result, and so the work for it, has a row for each pair of sources.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    lang, source = (F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source"))
    named = docs.select(lang, source, text, F.xxhash64(F.col("doc_id"), text).alias("doc"), F.xxhash64(F.lit(1), F.col("doc_id"), text).bitwiseOR(F.lit(1)).alias("copy"))
    named = named.withColumns({"lid": F.xxhash64("lang"), "gid": F.xxhash64("lang", "source")})
    names = stored(named.groupBy("lang", "source", "gid", "lid").agg(F.sum(F.octet_length("text")).alias("size")), "groups")
    for held, number in (("lang", "lid"), (F.struct("lang", "source"), "gid")):
        if not names.groupBy(number).agg(F.count_distinct(held).alias("n")).filter("n > 1").isEmpty():
            raise ValueError("two groups share a hash")
    size = names.agg(F.sum("size")).first()[0] or 0
    terms = stored(term_counts(named, size, least, broadcast_rows), "counts")

    per_lang = stored(terms.groupBy("lid", "term").agg(F.sum("count").alias("lang_count")), "languages")
    sizes = per_lang.groupBy("lid").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_count").alias("lang_n"))
    own = terms.groupBy("gid").agg(F.sum("count").alias("n"))
    zero = {c: F.coalesce(c, F.lit(0).cast("long")) for c in ("n", "v", "lang_n")}
    groups = names.drop("size").join(own, "gid", "left").join(sizes, "lid", "left").withColumns(zero).withColumnRenamed("gid", "group")
    groups = groups.withColumn("total", F.col("n") + 2 * F.col("v"))
    # Stored, so that Spark knows its size and broadcasts it while it is small.
    groups = stored(groups.withColumn("p0", F.when(F.col("v") > 0, rate(F.lit(0), F.col("total"))).otherwise(F.lit(1).cast("long"))), "rates")
    numbers = groups.select("group", "lang", "source", "v", "lang_n", "total", "p0")

    rated = terms.withColumnRenamed("gid", "group").join(numbers, "group").withColumn("p", rate(F.col("count"), F.col("total")))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    shape = ["lang", "source", "part", "item", "value"]

    q = rate(F.col("lang_count"), F.col("lang_n") + 2 * F.col("v"))
    marked = rated.join(per_lang, ["lid", "term"]).withColumn("q", q).filter(F.col("p") > F.col("q"))
    telling = marked.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), gap(F.col("p"), F.col("q")).alias("value"))
    telling = telling.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)

    a, b = groups.alias("a"), groups.alias("b")
    two = a.join(b, (F.col("a.lang") == F.col("b.lang")) & (F.col("a.group") != F.col("b.group")))
    base = two.select(F.col("a.group").alias("group"), F.col("b.group").alias("other"), (F.col("a.v") * gap(F.col("a.p0"), F.col("b.p0"))).alias("value"))
    alike = rated.groupBy("lang", "group", "p", "p0").agg(F.count(F.lit(1)).alias("m"))
    ends = groups.select("lang", F.col("group").alias("other"), F.col("p0").alias("q0"))
    lacking = (
        alike.join(ends, "lang")
        .filter("group <> other")
        .groupBy("group", "other")
        .agg(F.sum(F.col("m") * (gap(F.col("p"), F.col("q0")) - gap(F.col("p0"), F.col("q0")))).alias("value"))
    )
    lacking = lacking.unionByName(lacking.select(F.col("other").alias("group"), F.col("group").alias("other"), "value"))
    blocks = max(1, math.ceil(terms.count() / BLOCK_ROWS))
    block = F.pmod(F.xxhash64("lid", "term"), F.lit(blocks)).alias("block")
    shared = rated.select("lid", "term", "group", "p", "p0", block).groupBy("block").applyInPandas(shared_terms, "group long, other long, value long")
    summed = base.unionByName(lacking).unionByName(shared).groupBy("group", "other").agg(F.sum("value").alias("value"))
    names = groups.select("group", "lang", "source")
    others = groups.select(F.col("group").alias("other"), F.col("source").alias("item"))
    pairs = summed.join(names, "group").join(others, "other").withColumn("part", F.lit("pair")).select(shape)
    pairs = pairs.withColumn("rank", F.row_number().over(order))
    return pairs.unionByName(telling).select(*shape, F.col("rank").cast("int").alias("rank"))
