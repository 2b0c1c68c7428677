"""Words of a text as 64-bit hashes, cached per worker process in bounded memory."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import xxhash

#: About 200 bytes each, in each of an executor's workers.
CACHE = 100_000


class WordHashes(dict):
    """Hash of a word (bytes). Words over 64 bytes are not kept; a full cache starts anew."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) >= CACHE:
            self.clear()
        if len(word) <= 64:
            self[word] = h
        return h


@contextmanager
def word_hashes() -> Iterator[WordHashes]:
    """A cache for one task; a worker that goes on to another operator holds nothing of it."""
    cache = WordHashes()
    try:
        yield cache
    finally:
        cache.clear()


def hashed_words(text: bytes, cache: WordHashes) -> np.ndarray:
    """Hashes of the words ``[^\\x20\\x09-\\x0D]+`` of UTF-8 text, in order. (bytes.split parts at exactly these six.)"""
    words = text.split()
    return np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every bit over all 64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Distinct hashes, ascending, of all runs of ``k`` words; of the whole sequence if it is shorter; none without words."""
    n = len(words)
    if not n:
        return words
    m = min(n, k)
    h = np.full(n - m + 1, m, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(m):
            h = mix(h + words[j : n - m + 1 + j])
    return np.unique(h)
