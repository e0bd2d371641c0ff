"""Context-tree weighting over bytes: a weighted tree for each node of the binary decomposition of a byte.

A gram is a byte after the ``depth`` bytes before it, coded as one number with the oldest byte highest. The key
of a tree's node at some depth is the context of that length and then the binary node (1 to 255).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

END = 255  # a byte that UTF-8 never uses: stands before and after every text
STEPS = 8  # binary decisions of a byte
_LIMIT = 1e-12
_SLOTS = (22, 20)
_FREE = np.uint64(2**64 - 1)
_SPREAD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def grams_of(texts: list[bytes], depth: int) -> np.ndarray:
    """Codes of every byte (and the end) with the ``depth`` bytes before it, the oldest in the highest bits."""
    pad = bytes([END]) * depth
    flat = np.frombuffer(b"".join(pad + t + pad[:1] for t in texts), np.uint8)
    code = np.zeros(max(0, len(flat) - depth), np.uint64)
    for i in range(depth + 1):
        code = code << np.uint64(8) | flat[i : len(flat) - depth + i]
    # Windows that begin in one text and end in the next one's padding belong to neither.
    sizes = np.array([len(t) + depth + 1 for t in texts])
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    own = np.ones(len(code), bool)
    for back in range(1, depth + 1):
        cross = starts[1:] - back
        own[cross] = False
    return code[own]


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """log of the gamma function for x > 0: Stirling's series after a shift by eight."""
    shift = np.ones_like(x)
    for i in range(8):
        shift *= x + i
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - np.log(shift)


_HALF = float(_log_gamma(np.array([0.5]))[0])


def kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """log of the Krichevsky-Trofimov block probability; exactly 0 without counts."""
    small = np.where(zeros + ones > 0, 1.0, 0.0)
    value = _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - _log_gamma(zeros + ones + 1) - 2 * _HALF
    return value * small


def key_mask(depth: int) -> int:
    """Keeps the key of the node ``depth`` bytes deep above a deeper one."""
    return (1 << 8 * (depth + 1)) - 1


@dataclass(frozen=True)
class Level:
    """Nodes of one depth; ``up`` is the place of each one's parent in the next shorter level, if there is one."""

    key: np.ndarray
    zeros: np.ndarray
    ones: np.ndarray
    own: np.ndarray
    rest: np.ndarray
    up: np.ndarray | None = None


def mixed_weight(own: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """log weight of a node that may split: half its own estimate, half its children's product."""
    return np.logaddexp(own, rest) - np.log(2)


def climb(code: np.ndarray, n: np.ndarray, step: int, depth: int, top: int) -> tuple[np.ndarray, list[Level], np.ndarray]:
    """Weigh the trees of one binary step from ``depth`` up to ``top``.

    Gives each gram's place in the deepest level, the levels, deepest first, and the log weights of the last.
    Grams with n = 0 make nodes without counts, whose weight is 1.
    """
    byte = code & np.uint64(255)
    node = np.uint64(1 << step) | byte >> np.uint64(STEPS - step)
    bit = one_bits(code, step)
    keys, where = np.unique(code ^ byte | node, return_inverse=True)
    zeros, ones = (np.bincount(where, np.where(bit == b, n, 0), len(keys)) for b in (False, True))
    own = kt(zeros, ones)
    weight, levels = own, []
    level = (keys, zeros, ones, own, np.zeros_like(own))
    for d in range(depth - 1, top - 1, -1):
        shorter, up = np.unique(level[0] & np.uint64(key_mask(d)), return_inverse=True)
        levels.append(Level(*level, up))
        zeros, ones, rest = (np.bincount(up, x, len(shorter)) for x in (level[1], level[2], weight))
        own = kt(zeros, ones)
        weight = mixed_weight(own, rest)
        level = (shorter, zeros, ones, own, rest)
    return where, [*levels, Level(*level)], weight


def one_bits(code: np.ndarray, step: int) -> np.ndarray:
    return (code >> np.uint64(STEPS - 1 - step) & np.uint64(1)).astype(bool)


def descend(levels: Sequence[Level], done: np.ndarray, left: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """Probability of a one at every node of the deepest level.

    ``done``, ``left`` and ``edge`` say for the nodes of the shortest level what the contexts above them gave: the
    mixture so far, the weight left, and the prediction if the path ended above. A path ends at the deepest
    node with counts, which takes all the weight left.
    """
    for i, level in enumerate(reversed(levels)):
        if i:
            done, left, edge = done[level.up], left[level.up], edge[level.up]
        seen = level.zeros + level.ones > 0
        guess = (level.ones + 0.5) / (level.zeros + level.ones + 1)
        edge = np.where(seen, done + left * guess, edge)
        trust = np.where(seen, 1 / (1 + np.exp(np.clip(level.rest - level.own, -500, 500))), 0)
        done, left = done + left * trust * guess, left * (1 - trust)
    return np.clip(edge, _LIMIT, 1 - _LIMIT)


@dataclass(frozen=True)
class GramTable:
    """Values of grams in open slots, for a lookup of one access a table; grams that found no slot are left out."""

    keys: list[np.ndarray]
    values: list[np.ndarray]

    @classmethod
    def of(cls, keys: np.ndarray, values: np.ndarray) -> GramTable:
        """``keys`` come in order of importance: the first of those that share a slot gets it."""
        tables = []
        for most, spread in zip(_SLOTS, _SPREAD):
            bits = min(most, max(1, int(len(keys)).bit_length() + 1))
            slots, first = np.unique(keys * spread >> np.uint64(64 - bits), return_index=True)
            table, value = np.full(1 << bits, _FREE), np.zeros(1 << bits, np.float32)
            table[slots], value[slots] = keys[first], values[first]
            tables.append((table, value))
            left = np.ones(len(keys), bool)
            left[first] = False
            keys, values = keys[left], values[left]
        return cls([t for t, _ in tables], [v for _, v in tables])

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values, 0 for grams not held, and which ones are held."""
        value, held = np.zeros(len(keys)), np.zeros(len(keys), bool)
        for table, values, spread in zip(self.keys, self.values, _SPREAD):
            slots = (keys * spread >> np.uint64(64 - (len(table).bit_length() - 1))).astype(np.int64)
            here = table[slots] == keys
            value[here] = values[slots[here]]
            held |= here
        return value, held
