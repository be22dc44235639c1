"""Phrase collocations by sampling: Toivonen's method over word sequences.

A sample of the documents proposes phrases that may be frequent. A pass over all
documents then counts each proposed phrase and its negative border: every phrase that was
not proposed although the phrases without its first and without its last word were. A
border phrase that turns out frequent breaks the closure; such phrases are added to the
proposal, and a further pass counts the border they open, until no border phrase is
frequent. Then every frequent phrase has been counted.

The proposal reaches the tasks as a set of bits of bounded size, one for each hash of a
phrase. Strange phrases that share a bit are counted as well, which costs work and
changes no count. Phrases are first counted by a key of 64 bits, in the first pass by its
first 40. The next pass, which the
broken border needs anyway, counts the texts of the frequent keys; only these exact
counts are results, so two phrases that share a key do no harm.
"""

from __future__ import annotations

import collections
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from costlens.llm.bitsets import MOST_BITS, Bits, gather, joined
from costlens.llm.keycounts import PACKED, RANGE_BYTES, frequent, pack, range_bits, unpack
from costlens.llm.textops import FAMILIES, U64, batches, codes, distinct_spans, mix, span_hashes, text_bytes, window_hashes
from costlens.session import materialise, scratch_path

LONGEST = 5
LEAST = 100
TOP = 2000
SAMPLE = 8  # one document of so many proposes phrases
CAUTION = 0.5  # share of its expected count at which a sampled phrase is proposed
SLICE = 1 << 20  # bytes of text worked on at once
UNKNOWN = "und"
TEXT, KEY, TOTAL = range(3)
TOTAL_RANGE = -1
COUNTED = "key long, kind int, item string, n long"

_SPACE, _STOP = b"\x20\x09", b".,;:!?\x0a\x0b\x0c\x0d"
_CLASS = np.zeros(256, dtype=np.uint8)
_CLASS[list(_SPACE)] = 1
_CLASS[list(_STOP)] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACES = re.compile("[\x20\x09]+")
_EDGE = re.compile(rb"[\x20\x09.,;:!?\x0a-\x0d]")
_FOLLOWING = re.compile(rb"(?:[\x20\x09]*[^\x20\x09.,;:!?\x0a-\x0d]+){0,%d}" % (LONGEST - 1))


def _slices(raw: bytes, limit: int) -> Iterator[tuple[str, int]]:
    """Parts of a long text with the next four words, and the length that is the part's own."""
    at = 0
    while at < len(raw):
        edge = _EDGE.search(raw, at + limit)
        end = edge.start() if edge else len(raw)
        tail = _FOLLOWING.match(raw, end).end() if edge else end
        yield raw[at:tail].decode("utf-8", "surrogatepass"), end - at
        at = end


class Words:
    """The words of a batch of texts: their hashes, pieces and distinct forms."""

    def __init__(self, buffer: np.ndarray, offsets: np.ndarray, own: np.ndarray, langs: list[str]):
        buffer = _LOWER[buffer]
        kind = _CLASS[buffer]
        inside = np.zeros(len(buffer) + 2, dtype=bool)
        np.equal(kind, 0, out=inside[1:-1])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[0::2], edges[1::2]
        doc = np.searchsorted(offsets, starts, side="right") - 1
        self.piece = np.cumsum(kind == 2)[starts] if len(starts) else np.empty(0, np.int64)
        self.owned = starts < offsets[doc] + own[doc]
        number, names = codes(langs)
        # A language and its words make hashes of their own.
        salt = mix(span_hashes(*_packed(names), FAMILIES[1]) + U64(1))
        self.lang, self.names = number[doc], names
        word = span_hashes(buffer, starts, ends, FAMILIES[0])
        self.number = distinct_spans(buffer, starts, ends, word)[1]
        self.hash = mix(word ^ salt[self.lang])
        self.starts, self.ends, self.raw = starts, ends, buffer.tobytes()
        # Words that one space parts from the next: their phrase stands in the text as it is.
        self.close = np.append(starts[1:] - ends[:-1] == 1, False) & (buffer[np.minimum(ends, len(buffer) - 1)] == 0x20)

    def keys(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Key of the phrase that begins at each word, and whether it lies in one piece."""
        n = len(self.hash) - width + 1
        if n <= 0:
            return np.empty(0, U64), np.empty(0, bool)
        return mix(window_hashes(self.hash, width, FAMILIES[1]) + U64(width)), self.piece[:n] == self.piece[width - 1 :]

    def phrases(self, at: np.ndarray, keys: np.ndarray, width: int) -> tuple[np.ndarray, list[str], np.ndarray]:
        """Key, text (language, tab, phrase) and count of each phrase that begins at ``at``."""
        _, kept, number = np.unique(keys, return_index=True, return_inverse=True)
        like = at[kept][number]
        same = self.lang[at] == self.lang[like]
        for k in range(width):
            same &= self.number[at + k] == self.number[like + k]
        # A phrase that only shares its key stays a row of its own.
        counts = np.append(np.bincount(number[same], minlength=len(kept)), np.ones((~same).sum(), dtype=np.int64))
        rows = np.append(at[kept], at[~same])
        firsts, lasts = self.starts[rows].tolist(), self.ends[rows + width - 1].tolist()
        forms = [self.raw[a:b].decode("utf-8", "surrogatepass") for a, b in zip(firsts, lasts)]
        whole = np.ones(len(rows), dtype=bool)
        for k in range(width - 1):
            whole &= self.close[rows + k]
        for i in np.flatnonzero(~whole).tolist():
            forms[i] = _SPACES.sub(" ", forms[i])
        names = [f"{x}\t" for x in self.names]
        return np.append(keys[kept], keys[~same]), [names[c] + f for c, f in zip(self.lang[rows].tolist(), forms)], counts


def _packed(names) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = [b"\x01" + str(x).encode("utf-8", "surrogatepass") for x in names]
    ends = np.cumsum([len(x) for x in raw], dtype=np.int64)
    return np.frombuffer(b"".join(raw), dtype=np.uint8), np.append(0, ends[:-1])[: len(raw)].astype(np.int64), ends


def read_words(frame: pd.DataFrame) -> Iterator[Words]:
    """Words of whole texts, a few MB at a time; long texts come in slices."""
    texts, own, langs = [], [], []
    for lang, text in zip(frame["lang"], frame["text"]):
        raw = text.encode("utf-8", "surrogatepass")
        for part, length in [(text, len(raw))] if len(raw) <= SLICE else _slices(raw, SLICE):
            texts.append(part)
            own.append(length)
            langs.append(lang)
    for first, last, buffer, offsets in batches(texts, SLICE):
        yield Words(buffer, offsets, np.array(own[first:last], dtype=np.int64), langs[first:last])


def propose(words: Words) -> Iterator[pd.DataFrame]:
    """Keys of all phrases of a sampled batch and their counts."""
    for width in range(1, LONGEST + 1):
        keys, inside = words.keys(width)
        found, n = np.unique(keys[inside & words.owned[: len(keys)]], return_counts=True)
        yield pd.DataFrame({"key": found.view(np.int64), "n": n})


def count(words: Words, old: Bits | None, new: Bits) -> Iterator[pd.DataFrame]:
    """What a pass counts in one batch.

    The first pass (``old`` is none) counts by key every word and every phrase whose two
    parts one word shorter are in ``new``, the proposal. A later one counts the texts of
    the phrases in ``new``, found frequent by the pass before, and by key the phrases of
    which at least one part was not in ``old``; these count as proposed at once, so that
    a broken border is followed to its longest phrases in one pass.
    """

    def rows(kind, keys, items, n):
        return pd.DataFrame({"key": keys.view(np.int64), "kind": np.int32(kind), "item": pd.Series(items, index=range(len(keys)), dtype=object), "n": n})

    before = None
    for width in range(1, LONGEST + 1):
        keys, inside = words.keys(width)
        if not len(keys):
            return
        fresh = new.has(keys)
        known = old.has(keys) if old is not None else np.zeros(len(keys), dtype=bool)
        at = np.flatnonzero(inside & words.owned[: len(keys)])
        if width == 1:
            both = np.ones(len(at), dtype=bool)
            opened = both if old is None else ~both
        else:
            both = before[0][at] & before[0][at + 1]
            opened = both & ~(before[1][at] & before[1][at + 1])
            if old is not None:
                opened &= ~fresh[at]
        if old is None and width == 1:
            total = np.bincount(words.lang[at], minlength=len(words.names))
            yield rows(TOTAL, np.zeros(len(total), dtype=np.int64), [f"{x}\t" for x in words.names], total)
        text = at[both & fresh[at]] if old is not None else at[:0]
        if len(text):
            yield rows(TEXT, *words.phrases(text, keys[text], width))
        found, n = np.unique(keys[at[opened]], return_counts=True)
        yield rows(KEY, found, None, n)
        reached = fresh | known
        if old is not None:
            reached[at[opened]] = True
        before = (reached, known)


def _given(docs: DataFrame) -> DataFrame:
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang")
    return docs.select(F.col("doc_id"), lang, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def frequent_phrases(docs: DataFrame, least: int = LEAST, sample: int = SAMPLE, most_bits: int = MOST_BITS) -> DataFrame:
    """``lang, phrase, n`` of all phrases of up to five words that occur ``least`` times.

    The row of the empty phrase holds the number of words of each language. Each pass
    writes its frequent rows to the shared folder. There are two passes, and a third one
    if a broken border has opened frequent phrases.
    """
    spark = docs.sparkSession
    given = _given(docs)
    drawn = given.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(sample)) == 0).select("lang", "text")
    given = given.select("lang", "text")
    asked = max(1, int(least / sample * CAUTION))

    bits = range_bits(text_bytes(given)[1])
    few = range_bits((1 << bits) * RANGE_BYTES // sample)

    def proposing(frames):
        yield from pack(((own["key"].to_numpy().view(U64), own["n"].to_numpy()) for frame in frames for words in read_words(frame) for own in propose(words)), few)

    keys = materialise(frequent(drawn.mapInPandas(proposing, PACKED), few, asked).select("key"))
    new, _ = gather(keys, most_bits)
    old, passes, counted = None, [], []
    while True:
        held = spark.sparkContext.broadcast((old, new))

        def counting(frames, held=held):
            for frame in frames:
                for words in read_words(frame):
                    yield from count(words, *held.value)

        def packing(frames, held=held):
            totals: collections.Counter = collections.Counter()

            def keys():
                for frame in frames:
                    for words in read_words(frame):
                        for rows in count(words, *held.value):
                            if (rows["kind"] == TOTAL).all():
                                totals.update(dict(zip(rows["item"], rows["n"].tolist())))
                            else:
                                yield rows["key"].to_numpy().view(U64), rows["n"].to_numpy()

            for out in pack(keys(), bits):
                yield out.assign(item=None, n=0)
            yield pd.DataFrame({"range": TOTAL_RANGE, "keys": None, "counts": None, "item": pd.Series(list(totals), dtype=object), "n": pd.Series(list(totals.values()), dtype="int64")})

        path = scratch_path(spark, "phrases")
        if old is None:
            # Nearly all of these keys are rare; they travel packed. Totals are small.
            rows = first_counts(given.mapInPandas(packing, PACKED + ", item string, n long"), bits, least)
        else:
            rows = given.mapInPandas(counting, COUNTED).groupBy("key", "kind", "item").agg(F.sum("n").alias("n"))
            rows = rows.filter((F.col("n") >= least) | (F.col("kind") == TOTAL))
        rows.write.parquet(path)
        found = spark.read.schema(COUNTED).parquet(path)
        passes.append(found.filter(F.col("kind") != KEY).select("item", "n"))
        often = found.filter(F.col("kind") == KEY).select("key", "n")
        for texts in counted:
            # A phrase of that key and count has its text already: its bit was set by chance.
            often = often.join(texts, ["key", "n"], "left_anti")
        counted.append(found.filter(F.col("kind") == TEXT).select("key", "n").distinct())
        often = often.select("key").distinct()
        opened, n = gather(often, most_bits)
        if n == 0:
            break
        old, new = (new if old is None else joined(old, new)), opened
    every = passes[0]
    for more in passes[1:]:
        every = every.unionByName(more)
    # A phrase that two passes counted has the same count in both.
    every = every.groupBy("item").agg(F.max("n").alias("n"))
    phrase = F.substring_index("item", "\t", -1)
    return every.select(F.expr("substring(item, 1, length(item) - length(substring_index(item, '\t', -1)) - 1)").alias("lang"), phrase.alias("phrase"), "n")


def first_counts(packed: DataFrame, bits: int, least: int) -> DataFrame:
    """Rows of ``COUNTED`` from the packed rows of the first pass."""

    def add(place: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        if place[0] == TOTAL_RANGE:
            n = frame.groupby("item", sort=False)["n"].sum()
            return pd.DataFrame({"key": 0, "kind": TOTAL, "item": pd.Series(list(n.index), dtype=object), "n": n.to_numpy()})
        found = unpack(int(place[0]), frame, bits, least)
        return found.assign(kind=KEY, item=None)[["key", "kind", "item", "n"]]

    return packed.groupBy("range").applyInPandas(add, COUNTED)


def mine_collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, sample: int = SAMPLE, most_bits: int = MOST_BITS) -> DataFrame:
    """The ``top`` phrases of each language whose words occur together more than by chance.

    Candidates are phrases of two to five words with at least ``least`` occurrences; the
    score is that of their weakest cut. A candidate inside a longer one that is as
    frequent is dropped. Null texts count as empty, a null ``lang`` as ``und``; repeated
    rows count as often as they stand there; ``doc_id`` may be null or repeated, as it only
    helps to draw the sample; other columns are ignored. Texts are read whole, whatever
    their length. An empty table gives an empty result. Ties rank by count and then by
    phrase in byte order.
    """
    found = materialise(frequent_phrases(docs, least, sample, most_bits))
    totals = found.filter("phrase = ''").select("lang", F.col("n").alias("words"))
    known = found.filter("phrase <> ''")
    split = known.withColumn("w", F.split("phrase", " ")).withColumn("size", F.size("w"))
    candidates = split.filter("size >= 2")
    whole = F.concat_ws(" ", F.slice("w", 1, F.col("size") - 1)), F.concat_ws(" ", F.slice("w", 2, F.col("size") - 1))
    # A longer phrase that is as frequent contains phrases in between that are so too.
    inner = candidates.filter("size >= 3").select("lang", F.explode(F.array(*whole)).alias("phrase"), "n").distinct()
    open_ = candidates.join(inner, ["lang", "phrase", "n"], "left_anti")
    cuts = open_.select("lang", "phrase", F.col("n").alias("a"), "w", "size", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select(
        "lang", "phrase", "a", "k", F.concat_ws(" ", F.slice("w", F.lit(1), F.col("k"))).alias("head"), F.concat_ws(" ", F.slice("w", F.col("k") + 1, F.col("size") - F.col("k"))).alias("rest")
    )
    head = known.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l"))
    rest = known.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    # Products have up to 37 digits: counts below 1e15 each, the score below 1e18.
    score = F.expr("CAST(CAST(1000 AS DECIMAL(4,0)) * CAST(a AS DECIMAL(16,0)) * CAST(words AS DECIMAL(16,0)) AS DECIMAL(38,0)) div (CAST(l AS DECIMAL(16,0)) * CAST(r AS DECIMAL(16,0)))")
    scored = cuts.join(head, ["lang", "head"]).join(rest, ["lang", "rest"]).join(totals, "lang").withColumn("score", score)
    best = scored.groupBy("lang", "phrase", "a", F.col("words").alias("n")).agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    best = best.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    # Each language is ranked in parts first, so that its last task has a bounded number of rows.
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(64))
    first = best.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
