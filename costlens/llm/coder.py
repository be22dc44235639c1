"""Adaptive context-mixing range coder for token ids.

A block is coded from a fresh state, so that it can be read alone. An id is coded as one
of four events and, for the last two, a number:

0  the id that followed the last two ids when they were last seen (order 2),
1  the id that followed the last id when it was last seen (order 1),
2  an id seen before in the block: its place in order of first appearance (order 0),
3  any other id: itself.

The probability of an event mixes the counts of three contexts: how often the order-2
and order-1 predictions of late were right, which of them exist and agree, and the last
two events. Counts are halved when they grow, so the mixture follows the data.

Blocks are independent, and the blocks of a call are coded in lockstep: each step
handles one id of every block as array operations. The four counts of a context are the
16-bit fields of one 64-bit value, so that contexts are mixed, added up and learnt with one
operation for all events. What the encoder knows beforehand, such as which predictions
are right, it works out for many blocks and all their ids at once. A block is ``words``
of 32 bits; its checksum is kept beside it. Id 0 is never predicted, it marks a context
without a prediction.

The coder keeps 62 bits of the low end of the interval and shifts out 32 of them when the
interval is narrower than 2**30; a carry goes to the words before. The decoder needs the
distance from the low end alone.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64
SLOTS1, SLOTS2 = 11, 12  # bits of the prediction tables
SHIFT1, SHIFT2 = np.uint32(32 - SLOTS1), np.uint32(32 - SLOTS2)
BLOCK = 2048  # ids of a block
ID_BITS = 16
WIDEST, NARROW = U64(1 << 62), U64(1 << 30)  # interval at first, and where a word is shifted out
W30, W32 = U64(30), U64(32)
LIMIT = U64(240)  # sum above which counts are halved
REVIEW = 16  # steps between two looks at the sums
FIELD = U64(0xFFFF)  # of the counts of one event
EACH = U64(0x0001000100010001)  # one in each field; as a factor, fields become sums of all up to them
HALF = U64(0x7FFF7FFF7FFF7FFF)
SIGN = U64(0x0000800080008000)  # the upper bits of all fields but the last
TOP = U64(48)  # bits below the last field
TOGETHER = 16  # blocks that the encoder looks through at once
TRUST = np.array([[0, 1, 0], [0, 2, 1], [1, 3, 2], [1, 3, 3]])
# The same for both trusts at once: 4 times that of order 2 and that of order 1, then both outcomes.
TRUSTS = (TRUST[:, None, :, None] * 4 + TRUST[None, :, None, :]).reshape(-1)


def _hash(ids: np.ndarray) -> np.ndarray:
    """Of each id; its upper bits are the place of a context of one id."""
    return ids.astype(np.uint32) * np.uint32(0x9E3779B1)


def _hash2(before: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Of two ids with these hashes; its upper bits are the place of a context of two ids."""
    return before * np.uint32(0x85EBCA6B) + last


def _state(p1: np.ndarray, p2: np.ndarray, none1: np.ndarray, none2: np.ndarray) -> np.ndarray:
    """Which predictions are missing, of order 1 and twice that of order 2, and 4 more where they agree."""
    state = (p1 == p2).view(np.uint8) << np.uint8(2)
    state += none1
    state += none2
    state += none2
    return state


def _hits(p1: np.ndarray, p2: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether the predictions of order 1 and 2 are right."""
    some = ids != 0
    hit1, hit2 = p1 == ids, p2 == ids
    hit1 &= some
    hit2 &= some
    return hit1.view(np.uint8), hit2.view(np.uint8)


def _outcome(hit1: np.ndarray, hit2: np.ndarray, none1: np.ndarray, none2: np.ndarray) -> np.ndarray:
    """Wrong, right, no prediction: of order 1, and 3 times that of order 2."""
    outcome = (hit2 + none2 + none2) * np.uint8(3)
    outcome += hit1
    outcome += none1
    outcome += none1
    return outcome


class _Mixture:
    """Event counts of all lanes."""

    def __init__(self, lanes: int):
        # Of the three contexts, one after the other, 16 a lane.
        self.counts = np.full(3 * lanes * 16, EACH)
        self.rows = (np.arange(3)[:, None] * lanes + np.arange(lanes)) * 16
        self.at = np.empty_like(self.rows)
        self.held = np.empty(self.rows.shape, U64)
        self.turn = 0
        self.trust = np.zeros(lanes, dtype=np.int64)
        self.events = np.zeros(lanes, dtype=np.int64)

    def predict(self, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Frequencies of the events, and their sums up to each event, in fields."""
        at, held = self.at, self.held
        np.add(self.rows[0], self.trust, out=at[0])
        np.add(self.rows[1], state, out=at[1])
        np.add(self.rows[2], self.events, out=at[2])
        self.counts.take(at, out=held, mode="clip")
        f = held[0] + held[0]
        f += held[1]
        f += held[2]
        return f, f * EACH

    def update(self, event: np.ndarray, shift: np.ndarray, outcome: np.ndarray) -> None:
        """Learns from one event (``uint8``; ``shift``: bits below its field) of each lane;
        ended lanes learn rubbish harmlessly."""
        self.held += U64(8) << shift
        self.counts[self.at.reshape(-1)] = self.held.reshape(-1)
        self.turn += 1
        if self.turn % REVIEW == 0:
            c = self.counts
            full = np.flatnonzero(c * EACH >> TOP > LIMIT)
            c[full] = (c[full] + EACH) >> U64(1) & HALF
        self.trust *= 9
        self.trust += outcome
        self.trust = TRUSTS.take(self.trust)
        self.events <<= 2
        self.events += event
        self.events &= 15


def _order(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cells of all rows by row, key (below 65536) and place, and which of these are the first of a key."""
    width = keys.shape[1]
    ordered = keys.astype(np.uint32)
    ordered <<= np.uint32(16)
    ordered |= np.arange(width, dtype=np.uint32)
    ordered.sort(axis=1)
    order = (ordered & np.uint32(0xFFFF)).astype(np.int64)
    order += np.arange(len(keys))[:, None] * width
    ordered >>= np.uint32(16)
    first = np.ones(keys.shape, dtype=bool)
    np.not_equal(ordered[:, 1:], ordered[:, :-1], out=first[:, 1:])
    return order.reshape(-1), first.reshape(-1)


def _predicted(slots: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The id (``uint16``) that stood at the last cell of the same slot in the same row, 0 if none did."""
    order, first = _order(slots)
    ordered = ids.reshape(-1).take(order)
    ordered[1:] = ordered[:-1]
    ordered[first] = 0
    out = np.empty_like(ordered)
    out[order] = ordered
    return out.reshape(ids.shape)


def _foreseen(ids: np.ndarray):
    """Per id of some blocks: event, state of the predictions, their outcome, the number to
    code for an id that is not predicted, and one less than of how many."""
    shape, narrow = ids.shape, ids.astype(np.uint16)
    order, first = _order(narrow)
    new = np.empty(len(order), dtype=bool)
    new[order] = first
    fresh = new.reshape(shape)
    seen = np.cumsum(fresh, axis=1, dtype=np.int32)
    seen -= fresh
    # An id's place is the count of ids seen where it first stood.
    number = np.empty(len(order), dtype=np.uint16)
    number[order] = seen.reshape(-1).take(order[first]).take(np.cumsum(first) - 1)
    number[new] = narrow.reshape(-1)[new]
    among = np.maximum(seen - 1, 0).astype(np.uint16)
    among[fresh] = (1 << ID_BITS) - 1

    hashes = np.zeros((shape[0], shape[1] + 2), dtype=np.uint32)
    hashes[:, 2:] = _hash(narrow)
    p1 = _predicted(hashes[:, 1:-1] >> SHIFT1, narrow)
    p2 = _predicted(_hash2(hashes[:, :-2], hashes[:, 1:-1]) >> SHIFT2, narrow)
    none1, none2 = (p1 == 0).view(np.uint8), (p2 == 0).view(np.uint8)
    hit1, hit2 = _hits(p1, p2, narrow)
    event = fresh + np.uint8(2)
    event[hit1 > 0] = 1
    event[hit2 > 0] = 0
    deep = event > 1
    return event, _state(p1, p2, none1, none2), _outcome(hit1, hit2, none1, none2), number.reshape(shape) * deep, among * deep


def encode(ids: np.ndarray, lengths: np.ndarray) -> list[bytes]:
    """Code each row of ``ids`` (blocks by positions), of which ``lengths`` ids count."""
    lanes, steps = ids.shape
    columns = [np.empty((steps, lanes), dtype=kind) for kind in ("u1", "u1", "u1", "u2", "u2")]
    for a in range(0, lanes, TOGETHER):
        for column, some in zip(columns, _foreseen(ids[a : a + TOGETHER])):
            column[:, a : a + TOGETHER] = some.T
    mixture, lane = _Mixture(lanes), np.arange(lanes)
    low, span = np.zeros(lanes, U64), np.full(lanes, WIDEST)
    words = np.zeros((lanes, steps + 1), dtype="<u4")
    flat, filled = words.reshape(-1), lane * (steps + 1)
    shortest = min(lengths, default=0)
    for t in range(steps):
        event, state, outcome, number, among = (c[t] for c in columns)
        f, up = mixture.predict(state)
        shift = event.astype(U64)
        shift <<= U64(4)
        bottom, part = _event(span // (up >> TOP), f, up, shift)
        part //= among + U64(1)
        bottom += part * number
        bottom += low
        if t >= shortest:
            live = t < lengths
            bottom, part = np.where(live, bottom, low), np.where(live, part, span)
        low, span = bottom, part
        out = np.flatnonzero(span < NARROW)
        some = low[out]
        _emit(flat, filled[out], some >> W30)
        some &= NARROW - U64(1)
        low[out] = some << W32
        span[out] <<= W32
        filled[out] += 1
        mixture.update(event, shift, outcome)
    # The upper bits of a value inside the last interval whose other bits are zero.
    low += NARROW - U64(1)
    _emit(flat, filled, low >> W30)
    return [words[i, : n + 1].tobytes() for i, n in enumerate(filled - lane * (steps + 1))]


def _emit(words: np.ndarray, at: np.ndarray, some: np.ndarray) -> None:
    """Put words, with a bit of carry each, at their places."""
    words[at] = some & U64(0xFFFFFFFF)
    some >>= W32
    at = at[some > 0]
    while len(at):
        at = at - 1
        words[at] += np.uint32(1)
        at = at[words[at] == 0]


def _event(part: np.ndarray, f: np.ndarray, up: np.ndarray, shift: np.ndarray):
    """The interval of each lane's event: its distance from the low end and its span."""
    bottom = up - f
    bottom >>= shift
    bottom &= FIELD
    bottom *= part
    wide = f >> shift
    wide &= FIELD
    wide *= part
    return bottom, wide


def decode(blocks: list[bytes], lengths: np.ndarray) -> np.ndarray:
    """Ids of coded blocks as rows, zero beyond their lengths."""
    lanes, steps = len(blocks), int(max(lengths, default=0))
    width = max(map(len, blocks), default=0) // 4 + 3
    words = np.zeros((lanes, width), dtype="<u4")
    for i, raw in enumerate(blocks):
        words[i, : len(raw) // 4] = np.frombuffer(raw, dtype="<u4")
    code = words[:, 0].astype(U64) << W30 | words[:, 1] >> np.uint32(2)
    # From here on all words begin two bits earlier, behind the 62 that are read.
    words[:, 1:-1] = words[:, 1:-1] << np.uint32(30) | words[:, 2:] >> np.uint32(2)
    mixture, lane = _Mixture(lanes), np.arange(lanes)
    row1, row2 = lane << SLOTS1, lane << SLOTS2
    next1 = np.zeros(lanes << SLOTS1, dtype=np.uint16)
    next2 = np.zeros(lanes << SLOTS2, dtype=np.uint16)
    slot1, slot2, last = row1, row2, np.zeros(lanes, dtype=np.uint32)
    span = np.full(lanes, WIDEST)
    words, read = words.reshape(-1), lane * width + 1
    # Ids in order of appearance, and where the next one goes.
    place = lane * (steps + 1)
    listed, known = np.zeros(lanes * (steps + 1), dtype=np.uint16), place.copy()
    # By event: the id, and of how many a number is.
    held = np.empty((4, lanes), dtype=np.uint16)
    p2, p1 = held[0], held[1]
    among = np.ones((4, lanes), U64)
    among[3] = 1 << ID_BITS
    ids = np.zeros((steps, lanes), dtype=np.uint16)
    shortest = min(lengths, default=0)
    for t in range(steps):
        next1.take(slot1, out=p1, mode="clip")
        next2.take(slot2, out=p2, mode="clip")
        none1, none2 = (p1 == 0).view(np.uint8), (p2 == 0).view(np.uint8)
        f, up = mixture.predict(_state(p1, p2, none1, none2))
        part = span // (up >> TOP)
        # As many events end at or below the value as the fields of which it is no less.
        value = code // part
        value *= EACH
        value |= SIGN
        value -= up
        value &= SIGN
        event = np.bitwise_count(value)
        at = event.astype(np.int64)
        shift = (at << 4).view(U64)
        at *= lanes
        at += lane
        bottom, part = _event(part, f, up, shift)
        part //= among.take(at, mode="clip")
        bottom = code - bottom
        number = bottom // part
        bottom -= part * number
        number = number.view(np.int64)
        held[3] = number
        number += place
        listed.take(number, out=held[2], mode="clip")
        x, fresh = held.take(at, mode="clip"), event == 3
        if t >= shortest:
            live = t < lengths
            x *= live
            fresh &= live
            bottom, part = np.where(live, bottom, code), np.where(live, part, span)
        ids[t] = x
        code, span = bottom, part
        out = np.flatnonzero(span < NARROW)
        at = read[out]
        code[out] = code[out] << W32 | words[at]
        span[out] <<= W32
        read[out] = at + 1
        listed[known] = x
        known += fresh
        if t:
            among[2] += fresh
        mixture.update(event, shift, _outcome(*_hits(p1, p2, x), none1, none2))
        next1[slot1] = x
        next2[slot2] = x
        new = _hash(x)
        slot1 = row1 + (new >> SHIFT1)
        slot2 = row2 + (_hash2(last, new) >> SHIFT2)
        last = new
    return np.ascontiguousarray(ids.T)
