"""Token ids of whole texts, with a bounded memory of pieces seen before.

A text is cut at places where its tokenizer always starts afresh, so that a piece has
the same ids alone as inside the text. Pieces are found and looked up for many texts at
once; each distinct piece is given to the tokenizers library once per worker as long as
the memory holds it; a text whose white space or
special strings make cuts unsafe goes to the library whole.
"""

from __future__ import annotations

import itertools
import re
import sys
import types
import unicodedata
from collections.abc import Callable

import numpy as np

from costlens.llm.textops import FAMILIES, U64, distinct_spans, mix, ragged_cells, span_hashes

MEMORY = 800_000  # pieces a worker remembers
PIECE_BYTES = 16  # of all remembered pieces, on average
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=U64)  # bits of the first bytes

# A special string, or white space followed by a space and by more white space or the
# end, which the byte-level rule takes together.
_UNSAFE = re.compile(r"\s (?:\s|\Z)|<\|")
# Besides, two white-space characters in a row, the separator, or a full stop or comma
# that does not follow a letter or digit (a dotted capital I ends in a mark when lowered).
_PLAIN = re.compile(r"\s\s|<\||\x01|İ|(?:\A|[\W_])[.,](?:\s|\Z)")
# A mark that could combine with what stands before the white space; characters on which
# definitions of white space differ.
_MARK = re.compile(r"\s[\u0300-\u036f\u0483-\u0487\u0591-\u05bd\u0610-\u061a\u064b-\u065f\u0900-\u0dff\u1100-\u11ff\u1ab0-\u1aff\u1dc0-\u1dff\u20d0-\u20ff\u3099\u309a\ufe20-\ufe2f]|[\x1c-\x1f]")


PLAIN, CUT, WHOLE = 2, 1, 0  # cut at white space and marks, at spaces only, or nowhere

# First bytes of characters that the plain rule may refuse, and second bytes of these.
_STRANGE = ((0xC2, (0x85, 0xA0)), (0xC4, (0xB0,)), (0xE1, (0x9A,)), (0xE2, (0x80, 0x81)), (0xE3, (0x80,)))
# What it refuses in all texts: 1 white space of which two in a row, 2 always.
_CLASS = np.zeros(256, dtype=np.uint8)
_CLASS[[0x20, 0x0A]] = 1
_CLASS[[0x01, 0x09, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F]] = 2
_STOP = np.zeros(256, dtype=bool)
_STOP[[0x2C, 0x2E]] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
_SIGN = np.zeros(256, dtype=bool)  # ASCII other than letters, digits, white space and control characters
_SIGN[[b for b in range(33, 127) if not _LETTER[b]]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
MARKS = 0xCC  # first byte of the first character that combines with others


def _byte_form(text: str) -> tuple[str, int]:
    """A text of pieces that begin with a space; a space after text always starts a token."""
    return text, PLAIN if not _PLAIN.search(text) else WHOLE if _UNSAFE.search(text) else CUT


def _word_form(text: str) -> tuple[str, int]:
    """Runs without white space, which the tokenizer drops, and marks behind words.

    Cuts are made in the form that the tokenizer sees: a letter that normalisation takes
    apart ends in a mark, which belongs with a full stop behind it.
    """
    form = unicodedata.normalize("NFC", text)
    if _MARK.search(form) or "<|" in form:
        return text, WHOLE
    if not _PLAIN.search(form):
        form = form.replace(", ", " , ").replace(". ", " . ").replace(".\n", " .\n")
    return " ".join(form.split()), CUT


def _joined(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all texts, their offsets, and marks on the first and last byte of each."""
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    buffer = np.frombuffer(b"".join(raw), dtype=np.uint8)
    first, last = np.zeros(len(buffer), dtype=bool), np.zeros(len(buffer), dtype=bool)
    first[offsets[:-1][sizes > 0]] = True
    last[offsets[1:][sizes > 0] - 1] = True
    return buffer, offsets, first, last


def _all_plain(raw: list[bytes], marks: bool = False) -> np.ndarray:
    """Texts in which ``_PLAIN`` finds nothing for sure, all at once; every such ASCII text,
    and others unless they hold strange white space or marks behind strange letters. With
    ``marks`` neither does ``_MARK`` find anything in them."""
    buffer, offsets, first, last = _joined(raw)
    kind = _CLASS[buffer]
    space = kind == 1
    bad = kind == 2
    follows = ~last[:-1]
    bad[:-1] |= ((space[:-1] & space[1:]) | ((buffer[:-1] == 0x3C) & (buffer[1:] == 0x7C))) & follows
    if marks:
        bad[:-1] |= (space[:-1] & (buffer[1:] >= MARKS)) & follows
    for lead, second in _STRANGE:
        at = np.flatnonzero(buffer[:-1] == lead)
        bad[at] |= np.isin(buffer[at + 1], second)
    alone = _STOP[buffer]
    alone[:-1] &= space[1:] | last[:-1]
    alone = np.flatnonzero(alone)
    # Behind an ASCII letter or digit, or a letter of the first 256 characters.
    one, two = buffer[np.maximum(alone - 1, 0)], buffer[np.maximum(alone - 2, 0)]
    behind = ~first[alone] & (_LETTER[one] | ((one >= 0x80) & (two == 0xC3) & (one != 0x97) & (one != 0xB7)))
    plain = np.ones(len(raw), dtype=bool)
    for found in (np.flatnonzero(bad), alone[~behind]):
        plain[np.searchsorted(offsets, found, side="right") - 1] = False
    return plain


def _spans(raw: list[bytes], kinds: np.ndarray, spaces: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all texts, start and end of their pieces, and the pieces before each text.

    With ``spaces`` pieces hold the white space too and a piece may begin with a space;
    a line feed between words and a mark behind a word are pieces of their own. Without,
    a piece also ends between a letter and a sign, and letters A to Z become small in plain
    texts, unless characters that combine with others are near.
    """
    buffer, offsets, first, last = _joined(raw)
    kind = np.repeat(kinds.astype(np.uint8), np.diff(offsets))
    plain = kind == PLAIN
    space, line = (buffer == 0x20) & (kind != WHOLE), (buffer == 0x0A) & plain
    mark = np.zeros(len(buffer), dtype=bool)
    mark[:-1] = plain[:-1] & ~last[:-1] & (((buffer[:-1] == 0x2C) & space[1:]) | ((buffer[:-1] == 0x2E) & (space[1:] | line[1:])))
    begin = first | mark
    if spaces:
        begin |= space | line
        begin[1:] |= line[:-1]
        starts = np.flatnonzero(begin)
        ends = np.append(starts[1:], len(buffer))[: len(starts)]
    else:
        inside = ~(space | line)
        high = np.zeros(len(raw), dtype=bool)
        high[np.searchsorted(offsets, np.flatnonzero(buffer >= MARKS), side="right") - 1] = True
        easy = np.repeat((kinds == PLAIN) & ~high, np.diff(offsets))
        buffer = np.where(easy, _LOWER[buffer], buffer)
        small = easy & (buffer >= 97) & (buffer <= 122)
        begin[1:] |= small[:-1] & _SIGN[buffer[1:]] & ~last[:-1]
        begin[1:] |= ~inside[:-1]
        begin &= inside
        last[:-1] |= ~inside[1:] | begin[1:]
        starts, ends = np.flatnonzero(begin), np.flatnonzero(last & inside) + 1
    return buffer, starts, ends, np.searchsorted(starts, offsets)


def _byte_word(piece: str) -> str | None:
    """A piece that is a single token candidate, as the model sees it."""
    core = piece[1:] if piece[:1] == " " else piece
    if piece.isascii():
        return (core if core is piece else "\u0120" + core) if core.isalpha() else None
    return piece.encode().decode("latin-1").translate(_BYTES) if core.isalpha() else None


def _word_word(piece: str) -> str | None:
    if piece.isascii():
        return piece.lower() if piece.isalpha() else None
    # A final sigma depends on its place, and a letter may fall apart in lower case.
    lower = unicodedata.normalize("NFC", piece).lower()
    return lower.encode().decode("latin-1").translate(_BYTES) if piece.isalpha() and lower.isalpha() and "\u03a3" not in piece else None


# The byte-level alphabet: printable bytes stand for themselves, others for 256 and on.
_OWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTES = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _OWN)}

# Form of a text that is not plain for sure, whether only normalised texts can be, whether
# pieces hold white space, form of a piece.
RULES = {"byte": (_byte_form, False, True, _byte_word), "word": (_word_form, True, False, _word_word)}


def _shelf() -> dict:
    """Objects that live as long as the worker process, whatever carries this module."""
    return sys.modules.setdefault("_costlens_shelf", types.ModuleType("_costlens_shelf")).__dict__


def encoder(path: str, rule: str, memory: int = MEMORY) -> Callable[[list[str]], tuple[np.ndarray, np.ndarray]]:
    """Function from texts to ``ids, offsets``; no special tokens are added."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    shelf = _shelf()
    form, normal, spaces, single = RULES[rule]
    held = shelf.get((path, rule))
    if held is None:
        held = shelf[(path, rule)] = _Pieces(Tokenizer.from_file(path), single)

    def encode(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if held.n > memory or held.end > PIECE_BYTES * memory:
            held.forget(memory)
        fit = [not normal or t.isascii() or unicodedata.is_normalized("NFC", t) for t in texts]
        raw = [t.encode("utf-8", "surrogatepass") if f else b"" for t, f in zip(texts, fit)]
        sure = _all_plain(raw, normal) & np.array(fit, dtype=bool)
        kinds = np.where(sure, PLAIN, CUT)
        for i in np.flatnonzero(kinds == CUT).tolist():
            own, kinds[i] = form(texts[i])
            raw[i] = own.encode("utf-8", "surrogatepass")
        buffer, starts, ends, before = _spans(raw, kinds, spaces)
        return held.ids(held.numbers(buffer, starts, ends), before)

    return encode


def _grown(held: np.ndarray, size: int) -> np.ndarray:
    """Room for ``size`` cells at least, what is held first."""
    while size > len(held):
        held = np.concatenate([held, np.empty_like(held)])
    return held


def _keys(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two numbers of 64 bits and the size of each span. They tell spans of up to 16 bytes
    apart: the first and the last 8 bytes; the first number of a longer one is a hash."""
    sizes = ends - starts
    padded = np.concatenate([buffer, np.zeros(8, dtype=np.uint8)])
    eight = np.ndarray((len(buffer) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    head = eight[starts] & _FIRST[np.minimum(sizes, 8)]
    tail = eight[np.maximum(ends - 8, 0)]
    tail[sizes <= 8] = 0
    long = np.flatnonzero(sizes > 16)
    if len(long):
        ends = np.cumsum(sizes[long])
        head[long] = span_hashes(buffer[ragged_cells(starts[long], sizes[long])], ends - sizes[long], ends, FAMILIES[0])
    return head, tail, sizes.astype(np.int32)


class _Pieces:
    """Pieces seen before, found in an open table by their keys; long ones are then compared."""

    def __init__(self, tokenizer, single: Callable[[str], str | None]):
        self.tokenizer, self.model, self.single = tokenizer, tokenizer.model, single
        self.clear()

    def clear(self):
        self.n = self.end = 0
        self.head, self.tail = np.empty(1 << 16, U64), np.empty(1 << 16, U64)
        self.size, self.used = np.empty(1 << 16, np.int32), np.zeros(1 << 16, bool)
        self.raw, self.raw_at = np.empty(1 << 16, np.uint8), np.zeros(1 << 16, np.int64)
        self.flat, self.at = np.empty(1 << 16, np.uint32), np.zeros(1 << 16, np.int64)
        self.table = np.full(1 << 18, -1, dtype=np.int32)

    def forget(self, memory: int) -> None:
        """Keep what was seen again since the last time, if that leaves room."""
        kept = np.flatnonzero(self.used[: self.n])
        sizes, counts = self.size[kept], self.at[kept + 1] - self.at[kept]
        if 4 * len(kept) > 3 * memory or 4 * int(sizes.sum()) > 3 * PIECE_BYTES * memory:
            return self.clear()
        keys = self.head[kept], self.tail[kept], sizes
        raw, flat = self.raw[ragged_cells(self.raw_at[kept], sizes)], self.flat[ragged_cells(self.at[kept], counts)]
        self.clear()
        self._add(keys, raw, flat, counts)

    def numbers(self, buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Number of the piece of each span; new ones are learnt."""
        if not len(starts):
            return np.empty(0, np.int64)
        keys = _keys(buffer, starts, ends)
        number = self._find(buffer, starts, keys)
        self.used[number[number >= 0]] = True
        new = np.flatnonzero(number < 0)
        if len(new):
            starts, ends, keys = starts[new], ends[new], [k[new] for k in keys]
            kept, which = distinct_spans(buffer, starts, ends, self._hash(keys))
            number[new] = self.n + which
            self._learn(buffer, starts[kept], ends[kept], [k[kept] for k in keys])
        return number

    @staticmethod
    def _hash(keys) -> np.ndarray:
        head, tail, size = keys
        return mix(head ^ tail * U64(FAMILIES[0]) ^ size.astype(U64) << U64(56))

    def _find(self, buffer, starts, keys) -> np.ndarray:
        number = np.full(len(starts), -1, dtype=np.int64)
        end = len(self.table) - 1
        at, todo = self._hash(keys).view(np.int64) & end, np.arange(len(starts))
        while len(todo):
            found = self.table[at]
            same = (found >= 0) & (self.head[found] == keys[0]) & (self.tail[found] == keys[1]) & (self.size[found] == keys[2])
            number[todo[same]] = found[same]
            on = np.flatnonzero((found >= 0) & ~same)
            at, todo, keys = at[on] + 1 & end, todo[on], [k[on] for k in keys]
        long = np.flatnonzero(number >= 0)
        long = long[self.size[number[long]] > 16]
        if len(long):
            sizes = self.size[number[long]].astype(np.int64)
            equal = buffer[ragged_cells(starts[long], sizes)] == self.raw[ragged_cells(self.raw_at[number[long]], sizes)]
            number[long[~np.logical_and.reduceat(equal, np.cumsum(sizes) - sizes)]] = -1
        return number

    def _learn(self, buffer, starts, ends, keys) -> None:
        raw = buffer.tobytes()
        pieces = [raw[a:b].decode("utf-8", "surrogatepass") for a, b in zip(starts.tolist(), ends.tolist())]
        coded: list = []
        tokenize, single = self.model.tokenize, self.single
        for piece in pieces:
            word = single(piece)
            coded.append(None if word is None else [t.id for t in tokenize(word)])
        other = [i for i, c in enumerate(coded) if c is None]
        for i, x in zip(other, self.tokenizer.encode_batch_fast([pieces[i] for i in other], add_special_tokens=False)):
            coded[i] = x.ids
        counts = np.fromiter(map(len, coded), np.int64, len(coded))
        flat = np.fromiter(itertools.chain.from_iterable(coded), np.uint32, int(counts.sum()))
        self._add(keys, buffer[ragged_cells(starts, ends - starts)], flat, counts)

    def _add(self, keys, raw, flat, counts) -> None:
        """Take in pieces that are not held, given their keys, bytes, ids and ids each."""
        first, n = self.n, self.n + len(counts)
        for name, some in zip(("head", "tail", "size"), keys):
            setattr(self, name, _grown(getattr(self, name), n))
            getattr(self, name)[first:n] = some
        self.at, self.raw_at, self.used = _grown(self.at, n + 1), _grown(self.raw_at, n + 1), _grown(self.used, n)
        self.used[first:n] = False
        self.at[first + 1 : n + 1] = self.at[first] + np.cumsum(counts)
        self.raw_at[first + 1 : n + 1] = self.raw_at[first] + np.cumsum(keys[2])
        self.flat, self.raw = _grown(self.flat, self.at[n]), _grown(self.raw, self.raw_at[n])
        self.flat[self.at[first] : self.at[n]] = flat
        self.raw[self.raw_at[first] : self.raw_at[n]] = raw
        self.n, self.end = n, int(self.raw_at[n])
        if 2 * n > len(self.table):
            self.table = np.full(1 << (4 * n).bit_length(), -1, dtype=np.int32)
            first = 0
        # Of long pieces with the same keys the first is found again; others are learnt each time.
        end, todo = len(self.table) - 1, np.arange(first, n)
        at = self._hash((self.head[first:n], self.tail[first:n], self.size[first:n])).view(np.int64) & end
        while len(todo):
            free = self.table[at] < 0
            self.table[at[free]] = todo[free]
            on = np.flatnonzero(self.table[at] != todo)
            at, todo = at[on] + 1 & end, todo[on]

    def ids(self, which: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces in turn, and where those of each text begin and end."""
        start = self.at[which]
        size = self.at[which + 1] - start
        return self.flat[ragged_cells(start, size)], np.concatenate([[0], np.cumsum(size)])[before]
