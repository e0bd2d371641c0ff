"""Hashed words and word shingles of texts, in numpy."""

from __future__ import annotations

import numpy as np
import xxhash

from clickloom.llm.common import mixed

_BASE = np.uint64(0x9E3779B97F4A7C15)
MEMO_WORDS = 50_000
# A-Z to lower case, every other ASCII character that is no letter or digit to a blank.
PLAIN = bytes(ord(chr(b).lower()) if b > 127 or chr(b).isalnum() else 32 for b in range(128)) + bytes(range(128, 256))


class WordHashes(dict):
    """64-bit hashes of lower-cased words, remembered for the most recent vocabulary."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h

    def plain(self, text: str) -> np.ndarray:
        """Words without ASCII punctuation."""
        words = text.encode("utf-8", "replace").translate(PLAIN).split()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))

    def of(self, text: str) -> np.ndarray:
        # bytes.lower() and bytes.split() know only A-Z and the six ASCII space characters.
        words = text.encode("utf-8", "replace").lower().split()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-word windows, in order; of the whole sequence if it is shorter; none without words."""
    width = min(n, len(words))
    if not width:
        return np.empty(0, np.uint64)
    h = np.full(len(words) - width + 1, width, np.uint64)
    for i in range(width):
        h = h * _BASE + words[i : len(words) - width + 1 + i]
    return mixed(h)


def shingle_set(words: np.ndarray, n: int = 5) -> np.ndarray:
    """The sorted distinct n-word shingles."""
    return np.unique(grams(words, n))
