"""Context-mixing range coder for token ids; the stretches of a block are coded side by side.

A block starts from an empty model and is cut into lanes, which are coded step by step together and learn into
one model. For every id two tables propose the id that last followed the previous one (order 1) and the previous
two (order 2). Whether one of them is right is coded with the record of such slots, told apart by the confidence of
both. Other ids fall back on order 0: the frequencies of the ids so far, and 32 plain bits for one without any.
What a few steps teach is learned at their end, so that tables are looked up and changed for many ids at once.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np

MAGIC = b"CMR2"
HEADER = struct.Struct("<4sIIII")  # magic, ids, crc32 of the ids as little-endian 32 bit, alphabet, code words
LANES, LANE_IDS = 2048, 1024  # most lanes of a block, and the ids of a lane before there is another
STEPS = 32  # between two times of learning
SLOT_BITS = 16
CONFIDENT, TRUST_BITS = 4, 3
EVENT_BITS, ID_BITS = 12, 16
ALPHABET = 1 << 18  # ids from here on have no frequency of their own
LIMIT = 1 << 18
_U = np.uint64
_FULL, _LEAST, _WORD, _HALF = _U(0xFFFFFFFFFFFFFFFF), _U(1 << 32), _U(32), _U(16)
_EVENT_BITS, _ID_BITS = _U(EVENT_BITS), _U(ID_BITS)


class _Model:
    """What a block's ids so far tell of the next ones."""

    def __init__(self, alphabet: int):
        self.alphabet = alphabet
        # The id and, below it, its confidence.
        self.slots = [np.zeros(1 << SLOT_BITS, _type_of(alphabet)) for _ in range(2)]
        self.events = np.tile(np.array([4, 2, 6], np.int64), (1 << 2 * TRUST_BITS, 1))
        self.edges = np.zeros((len(self.events), 4), np.uint64)
        self.edges[:, 3] = 1 << EVENT_BITS
        self.counts, self.counted = np.zeros(alphabet, np.int64), 0
        self.waiting: list[np.ndarray] = []
        self.n_waiting = 0
        self._weigh()
        self._rank()

    def _weigh(self) -> None:
        share = self.events[:, :2] * ((1 << EVENT_BITS) - 3) // self.events.sum(axis=1)[:, None] + 1
        np.cumsum(share, axis=1, out=share)
        self.edges[:, 1:3] = share

    def _rank(self) -> None:
        """Order 0 in ``1 << ID_BITS`` parts: one or more for each id met, the rest for those without."""
        room, least = 1 << ID_BITS, 1
        while (known := np.flatnonzero(self.counts >= least)).size > room >> 1:
            least *= 2
        seen = self.counts[known]
        parts = seen * (room - 1 - known.size) // max(1, int(seen.sum())) + 1 if known.size else seen
        open_from = int(parts.sum())
        # Behind the alphabet stand the ids without a frequency, and what a right guess needs: nothing.
        self.low = np.full(self.alphabet + 2, open_from, _U)
        self.size = np.full(self.alphabet + 2, room - open_from, _U)
        self.low[known], self.size[known] = np.cumsum(parts) - parts, parts
        self.low[-1], self.size[-1] = 0, room
        self.open = np.ones(self.alphabet + 2, bool)
        self.open[known] = self.open[-1] = False
        self.at_part = np.full(room, self.alphabet, self.slots[0].dtype)
        self.at_part[:open_from] = np.repeat(known, parts)

    def predict(self, last: np.ndarray, older: np.ndarray) -> None:
        mask = (1 << SLOT_BITS) - 1
        self.at = ((last * 10007 + older * 40503) >> 4) & mask, last & mask
        self.held = [s.take(i) for s, i in zip(self.slots, self.at)]
        self.sure = [h & ((1 << TRUST_BITS) - 1) for h in self.held]
        self.guess = [h >> TRUST_BITS for h in self.held]
        two, one = self.guess
        self.cell = (self.sure[0] << TRUST_BITS) + self.sure[1] * (one != two)

    def event_of(self, ids: np.ndarray) -> np.ndarray:
        self.right = [ids == g for g in self.guess]
        return np.where(self.right[0], 0, 2 - self.right[1])

    def learn(self, ids: np.ndarray, event: np.ndarray) -> None:
        """Take in the ids that the last prediction was for; of several for one slot the last one stays."""
        new = (ids << TRUST_BITS) + 1
        for slots, at, held, sure, right in zip(self.slots, self.at, self.held, self.sure, self.right):
            slots[at] = np.where(right, held + (sure < CONFIDENT), np.where(sure > 1, held - 1, new))
        met = np.bincount((self.cell * 3 + event).ravel(), minlength=self.events.size)
        self.events += met.reshape(self.events.shape)
        large = self.events.sum(axis=1) > LIMIT
        self.events[large] = (self.events[large] >> 1) + 1
        self._weigh()
        self.waiting.append(ids)
        self.n_waiting += ids.size
        if self.n_waiting > self.counted >> 1:
            new = np.concatenate([x.ravel() for x in self.waiting])
            self.counts += np.bincount(new[new < self.alphabet], minlength=self.alphabet)
            self.counted += self.n_waiting
            self.waiting, self.n_waiting = [], 0
            self._rank()


def _type_of(alphabet: int) -> type:
    """Of ids, with room for their confidence."""
    return np.int32 if alphabet < ALPHABET else np.int64


def _laid(n: int) -> tuple[int, int]:
    """Steps and lanes of a block of ``n`` ids."""
    steps = -(-n // min(LANES, max(1, n // LANE_IDS))) if n else 0
    return steps, -(-n // steps) if n else 0


def _turns(steps: int) -> Iterator[tuple[int, int]]:
    """Runs of steps at whose end the model learns: short ones first."""
    at = 0
    while at < steps:
        stop = min(steps, at + min(STEPS, max(1, at)))
        yield at, stop
        at = stop


class _Encoder:
    def __init__(self, lanes: int, steps: int):
        # At most 60 bits an id.
        self.width = 2 * steps + 4
        self.low, self.range = np.zeros(lanes, _U), np.full(lanes, _FULL, _U)
        self.out, self.n = np.zeros(lanes * self.width, np.uint32), np.arange(lanes) * self.width

    def narrow(self, start, size, low, part) -> None:
        """All lanes: an event's part of the range, and inside it an id's part."""
        unit = self.range >> _EVENT_BITS
        inner = (unit * size) >> _ID_BITS
        self._set(slice(None), self.low + (unit * start + inner * low), inner * part)

    def plain(self, lanes: np.ndarray, ids: np.ndarray) -> None:
        for half in (ids >> 16, ids & 0xFFFF):
            unit = self.range[lanes] >> _HALF
            self._set(lanes, self.low[lanes] + unit * half.astype(_U), unit)

    def _set(self, lanes, low, width) -> None:
        over = low < self.low[lanes]
        self.low[lanes], self.range[lanes] = low, width
        if over.any():
            self._carry(np.flatnonzero(over) if isinstance(lanes, slice) else lanes[over])
        short = np.flatnonzero(width < _LEAST)
        if len(short):
            short = short if isinstance(lanes, slice) else lanes[short]
            self.put(short)
            self.range[short] <<= _WORD

    def _carry(self, lanes: np.ndarray) -> None:
        at = self.n[lanes] - 1
        while len(at):
            self.out[at] += np.uint32(1)
            at = at[self.out[at] == 0] - 1

    def put(self, lanes: np.ndarray) -> None:
        low = self.low[lanes]
        self.out[self.n[lanes]] = low >> _WORD
        self.low[lanes] = low << _WORD
        self.n[lanes] += 1


def encode(blocks: list[np.ndarray]) -> list[bytes]:
    """Code blocks of ids below 2^32."""
    return [_encode(np.asarray(b)) for b in blocks]


def _encode(block: np.ndarray) -> bytes:
    steps, lanes = _laid(len(block))
    alphabet = min(ALPHABET, int(block.max(initial=0)) + 1)
    ids = np.zeros((steps + 2, lanes), _type_of(alphabet))
    if steps:
        flat = np.zeros(lanes * steps, np.uint32)
        flat[: len(block)] = block
        ids[2:] = flat.reshape(lanes, steps).T
    model, coder = _Model(alphabet), _Encoder(lanes, steps)
    for begin, end in _turns(steps):
        now = ids[begin + 2 : end + 2]
        model.predict(ids[begin + 1 : end + 1], ids[begin:end])
        event = model.event_of(now)
        edge = (model.cell << 2) + event
        start = model.edges.take(edge)
        size = model.edges.take(edge + 1) - start
        symbol = np.where(event < 2, alphabet + 1, np.minimum(now, alphabet))
        low, part = model.low.take(symbol), model.size.take(symbol)
        plain = model.open.take(symbol)
        some = plain.any(axis=1).tolist()
        for i in range(end - begin):
            coder.narrow(start[i], size[i], low[i], part[i])
            if some[i]:
                own = np.flatnonzero(plain[i])
                coder.plain(own, now[i, own].astype(np.int64))
        model.learn(now, event)
    for _ in range(2):
        coder.put(np.arange(lanes))
    begin = np.arange(lanes) * coder.width
    counts = (coder.n - begin).astype("<u4")
    words = b"".join(coder.out[a:b].astype("<u4").tobytes() for a, b in zip(begin.tolist(), coder.n.tolist()))
    crc = zlib.crc32(block.astype("<u4").tobytes())
    return HEADER.pack(MAGIC, len(block), crc, alphabet, len(words) // 4) + counts.tobytes() + words


def decode(coded: list[bytes]) -> list[np.ndarray]:
    """The blocks again, as unsigned 32-bit ids; damage raises ValueError."""
    return [_decode(c) for c in coded]


def _decode(coded: bytes) -> np.ndarray:
    magic, n, crc, alphabet, n_words = HEADER.unpack_from(coded) if len(coded) >= HEADER.size else (b"", 0, 0, 0, 0)
    steps, lanes = _laid(n)
    if magic != MAGIC or alphabet > ALPHABET or len(coded) != HEADER.size + 4 * (lanes + n_words):
        raise ValueError("not a block of ids")
    counts = np.frombuffer(coded, "<u4", lanes, HEADER.size).astype(np.int64)
    if counts.sum() != n_words or (counts < 2).any():
        raise ValueError("a block of ids is damaged")
    # A damaged block may read on behind its words.
    words = np.append(np.frombuffer(coded, "<u4", offset=HEADER.size + 4 * lanes), [0, 0]).astype(_U)
    read = np.cumsum(counts) - counts + 2
    code, width = words[read - 2] << _WORD | words[read - 1], np.full(lanes, _FULL, _U)
    ids = np.zeros((steps + 2, lanes), _type_of(alphabet))
    model = _Model(alphabet)
    none, all_events, right = _U(0), _U(1 << EVENT_BITS), ids.dtype.type(alphabet + 1)

    def shift(lanes: np.ndarray) -> None:
        at = read[lanes]
        code[lanes] = code[lanes] << _WORD | words.take(at, mode="clip")
        width[lanes] <<= _WORD
        read[lanes] = at + 1

    for begin, end in _turns(steps):
        first, second = model.edges[:, 1].copy(), model.edges[:, 2].copy()
        for step in range(begin, end):
            model.predict(ids[step + 1], ids[step])
            unit = width >> _EVENT_BITS
            value = code // unit
            one, two = first.take(model.cell), second.take(model.cell)
            later, missed = value >= one, value >= two
            start = np.where(missed, two, np.where(later, one, none))
            inner = (unit * (np.where(missed, all_events, np.where(later, two, one)) - start)) >> _ID_BITS
            code -= unit * start
            # A damaged block may have any code.
            part = (code // inner).astype(np.int64)
            symbol = np.where(missed, model.at_part.take(part, mode="clip"), right)
            code -= inner * model.low.take(symbol)
            width = inner * model.size.take(symbol)
            shift(np.flatnonzero(width < _LEAST))
            now = np.where(missed, symbol, np.where(later, model.guess[1], model.guess[0]))
            own = np.flatnonzero(symbol == alphabet)
            if len(own):
                plain = np.zeros(len(own), np.int64)
                for _ in range(2):
                    unit = width[own] >> _HALF
                    half = np.minimum(code[own] // unit, _U(0xFFFF))
                    code[own] -= unit * half
                    width[own] = unit
                    shift(own[unit < _LEAST])
                    plain = plain << 16 | half.astype(np.int64)
                now[own] = plain
            ids[step + 2] = now
        now = ids[begin + 2 : end + 2]
        model.predict(ids[begin + 1 : end + 1], ids[begin:end])
        model.learn(now, model.event_of(now))
    flat = ids[2:].T.astype("<u4").reshape(-1)[:n]
    if zlib.crc32(flat.tobytes()) != crc:
        raise ValueError("a block of ids is damaged")
    return flat
