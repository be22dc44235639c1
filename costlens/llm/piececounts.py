"""Token counts of whole texts by merging ragged arrays rank by rank.

A text is cut wherever no piece of the vocabulary holds the two characters on both
sides, so no merge ever crosses a cut. The distinct runs of a batch lie in one ragged
array; in each step every run applies its pair of lowest rank (the leftmost, if the rank
occurs more than once), all runs at once, until no pair is left. A run's token count is
the number of symbols that survive, with one token a byte for characters that the
vocabulary lacks.
"""

from __future__ import annotations

import heapq
import sys
import types
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlens.llm.textops import FAMILIES, distinct_spans, ragged_cells, span_hashes

NONE = np.int32(1 << 30)  # rank of a pair that no piece is made of
WINDOW = 1 << 20  # characters worked on at once
LONG = 256  # symbols from which a run goes through a heap of its own
LIMIT = 4096
RESULT = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


class Merges:
    """The pairs of a sentencepiece BPE vocabulary with byte fallback, as arrays."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        spec, kinds = model.normalizer_spec, sentencepiece_model_pb2.ModelProto.SentencePiece
        if model.trainer_spec.model_type != 2 or not model.trainer_spec.byte_fallback:
            raise ValueError(f"{path} is no BPE vocabulary with byte fallback")
        if any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces):
            raise ValueError(f"{path} has user-defined or unused pieces")
        plain = not spec.precompiled_charsmap and not spec.remove_extra_whitespaces and spec.escape_whitespaces
        self.normalize = None if plain else sentencepiece.SentencePieceProcessor(model_file=path).normalize
        self.prefix = "▁" if spec.add_dummy_prefix else ""
        score = {p.piece: p.score for p in model.pieces if p.type == kinds.NORMAL}
        chars = sorted({c for p in score for c in p})
        symbols = {s: i for i, s in enumerate([*chars, *(p for p in score if len(p) > 1)])}
        ranks = {s: i for i, s in enumerate(sorted(set(score.values()), reverse=True))}
        # Characters in pieces of more than one, and which of them stand side by side.
        joined = {c: i + 1 for i, c in enumerate(sorted({c for p in score if len(p) > 1 for c in p}))}
        self.beside = np.zeros((len(joined) + 1, len(joined) + 1), dtype=bool)
        pairs = []
        for piece, value in score.items():
            for k in range(1, len(piece)):
                self.beside[joined[piece[k - 1]], joined[piece[k]]] = True
                if piece[:k] in symbols and piece[k:] in symbols:
                    pairs.append((symbols[piece[:k]] * len(symbols) + symbols[piece[k:]], ranks[value], symbols[piece]))
        pairs.sort()
        self.base = len(symbols)
        self.keys, self.ranks, self.made = (np.array([p[i] for p in pairs], dtype=t) for i, t in enumerate((np.int64, np.int32, np.int32)))
        self.symbol = np.full(0x110000, -1, dtype=np.int32)
        self.place = np.zeros(0x110000, dtype=np.int32)
        for c in chars:
            self.symbol[ord(c)] = symbols[c]
        for c, i in joined.items():
            self.place[ord(c)] = i
        # Tokens of a symbol that is left: a character that is no piece falls into bytes.
        self.weight = np.array([1 if s in score else len(s.encode()) for s in symbols], dtype=np.int64)

    def points(self, text: str) -> np.ndarray:
        """Code points of a normalised text."""
        if self.normalize is not None:
            text = self.normalize(text)
        elif text:
            text = self.prefix + text.replace(" ", "▁")
        return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)

    def joins(self, points: np.ndarray) -> np.ndarray:
        """Whether some piece holds each character and the next one side by side."""
        at = self.place[points]
        return self.beside[at[:-1], at[1:]]

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair of symbols (``NONE`` if no piece) and what it merges into."""
        want = left.astype(np.int64) * self.base + right
        at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
        found = (self.keys[at] == want) & (left >= 0) & (right >= 0)
        return np.where(found, self.ranks[at], NONE), np.where(found, self.made[at], -1)

    def singles(self, points: np.ndarray) -> np.ndarray:
        """Tokens of each character alone."""
        symbol = self.symbol[points]
        width = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
        return np.where(symbol >= 0, self.weight[symbol], width)


def merge_runs(merges: Merges, symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Surviving tokens of each run of symbols, all runs a step at a time.

    Arrays hold the runs that still have a pair; a finished run leaves them.
    """
    total = np.zeros(len(lengths), dtype=np.int64)
    which = np.arange(len(lengths))
    for i in np.flatnonzero(lengths > LONG):
        first = int(lengths[:i].sum())
        total[i] = _merge_long(merges, symbols[first : first + lengths[i]])
    short = lengths <= LONG
    symbols, which, lengths = symbols[np.repeat(short, lengths)], which[short], lengths[short]
    ends = np.cumsum(lengths)
    ranks, made = merges.look_up(symbols, np.append(symbols[1:], np.int32(-1)))
    ranks[ends - 1] = NONE
    while len(which):
        starts = ends - lengths
        least = np.minimum.reduceat(ranks, starts)
        done = least == NONE
        if done.any():
            total[which[done]] = np.add.reduceat(merges.weight[symbols], starts)[done]
            stay = ~done
            cells = np.repeat(stay, lengths)
            symbols, ranks, made = symbols[cells], ranks[cells], made[cells]
            which, lengths, least = which[stay], lengths[stay], least[stay]
            ends = np.cumsum(lengths)
            if not len(which):
                break
            starts = ends - lengths
        hits = np.flatnonzero(ranks == np.repeat(least, lengths))
        owner = np.searchsorted(ends, hits, side="right")
        at = hits[np.append(True, owner[1:] != owner[:-1])]  # the leftmost of each run
        symbols[at] = made[at]
        cells = np.ones(len(symbols), dtype=bool)
        cells[at + 1] = False
        symbols, ranks, made = symbols[cells], ranks[cells], made[cells]
        lengths = lengths - 1
        ends = np.cumsum(lengths)
        at = at - np.arange(len(at))  # every run before has lost one symbol
        first, last = ends - lengths, ends - 1
        ranks[at] = NONE
        inner = at < last
        ranks[at[inner]], made[at[inner]] = merges.look_up(symbols[at[inner]], symbols[at[inner] + 1])
        before = at[at > first] - 1
        ranks[before], made[before] = merges.look_up(symbols[before], symbols[before + 1])
    return total


def _merge_long(merges: Merges, symbols: np.ndarray) -> int:
    """The same order of merges for one long run, by a heap of its pairs."""
    symbols, n = symbols.tolist(), len(symbols)
    ahead, behind = list(range(1, n + 1)), list(range(-1, n - 1))
    known: dict[tuple[int, int], tuple[int, int]] = {}

    def pair(left: int, right: int) -> tuple[int, int]:
        found = known.get((left, right))
        if found is None:
            rank, made = merges.look_up(np.array([left], dtype=np.int32), np.array([right], dtype=np.int32))
            found = known[(left, right)] = (int(rank[0]), int(made[0]))
        return found

    none, heap = int(NONE), []
    for i in range(n - 1):
        rank, _ = pair(symbols[i], symbols[i + 1])
        if rank < none:
            heap.append((rank, i, i + 1, symbols[i], symbols[i + 1]))
    heapq.heapify(heap)
    gone = bytearray(n)
    while heap:
        _, i, j, left, right = heapq.heappop(heap)
        if gone[i] or gone[j] or symbols[i] != left or symbols[j] != right or ahead[i] != j:
            continue
        symbols[i], gone[j], after = pair(left, right)[1], 1, ahead[j]
        ahead[i] = after
        if after < n:
            behind[after] = i
            if (rank := pair(symbols[i], symbols[after])[0]) < none:
                heapq.heappush(heap, (rank, i, after, symbols[i], symbols[after]))
        if (k := behind[i]) >= 0 and (rank := pair(symbols[k], symbols[i])[0]) < none:
            heapq.heappush(heap, (rank, k, i, symbols[k], symbols[i]))
    return sum(int(merges.weight[s]) for s, g in zip(symbols, gone) if not g)


def count_points(merges: Merges, points: np.ndarray, joins: np.ndarray, owners: np.ndarray, n: int) -> np.ndarray:
    """Tokens of ``n`` texts; ``owners`` gives each character's text, ``joins`` its runs."""
    edges = np.flatnonzero(np.concatenate([[True], ~joins, [True]]))
    starts, ends = edges[:-1], edges[1:]
    total = np.zeros(n, dtype=np.int64)
    alone = starts[ends - starts == 1]
    np.add.at(total, owners[alone], merges.singles(points[alone]))
    many = ends - starts > 1
    starts, ends = starts[many], ends[many]
    if not len(starts):
        return total
    lengths = ends - starts
    kept, number = distinct_spans(points, starts, ends, span_hashes(points, starts, ends, FAMILIES[0]))
    tokens = merge_runs(merges, merges.symbol[points[ragged_cells(starts[kept], lengths[kept])]], lengths[kept])
    np.add.at(total, owners[starts], tokens[number])
    return total


def count_texts(merges: Merges, texts: list[str]) -> np.ndarray:
    """Tokens of each text, about ``WINDOW`` characters at a time.

    A longer text is worked on in parts that end at a cut between two runs.
    """
    total = np.zeros(len(texts), dtype=np.int64)
    held, size = [], 0

    def flush():
        nonlocal held, size
        if held:
            lengths = [len(p) for _, p in held]
            points, owners = np.concatenate([p for _, p in held]), np.repeat(np.arange(len(held)), lengths)
            joins = merges.joins(points)
            joins[np.cumsum(lengths)[:-1] - 1] = False
            np.add.at(total, [i for i, _ in held], count_points(merges, points, joins, owners, len(held)))
        held, size = [], 0

    for i, text in enumerate(texts):
        points, reach = merges.points(text), WINDOW
        while len(points) > reach:
            cuts = np.flatnonzero(~merges.joins(points[:reach]))
            if len(cuts):
                held.append((i, points[: cuts[-1] + 1]))
                points, reach = points[cuts[-1] + 1 :], WINDOW
                flush()
            else:
                reach *= 2  # one run of more than a window
        if len(points):
            held.append((i, points))
            size += len(points)
        if size >= WINDOW:
            flush()
    flush()
    return total


def load(path: str) -> Merges:
    """The vocabulary, read once a worker."""
    shelf = sys.modules.setdefault("_costlens_shelf", types.ModuleType("_costlens_shelf")).__dict__
    key = ("merges", path)
    if key not in shelf:
        shelf[key] = Merges(path)
    return shelf[key]


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """Bytes and tokens of each whole text, and whether it has more than ``limit`` tokens.

    ``path`` names a sentencepiece BPE model with byte fallback that every executor can
    read. No begin, end or other special token is counted, and special strings inside a
    text are ordinary text. A null text counts as empty: no bytes, no tokens. One row for
    each row, repeated rows and null ``doc_id`` included; other columns are ignored; an
    empty table gives an empty result. Texts may be of any length: memory follows
    ``WINDOW`` and the longest single run. Nothing is shuffled.
    """

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        merges = load(path)
        for frame in frames:
            tokens = count_texts(merges, frame["text"].tolist())
            yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "n_bytes": frame["n_bytes"], "n_tokens": tokens, "over_limit": tokens > limit})

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    return given.mapInPandas(count, RESULT)
