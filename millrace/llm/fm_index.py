"""A compressed FM-index over integer symbols: Burrows-Wheeler transform in a wavelet matrix, searched many patterns at a time."""

from __future__ import annotations

import numpy as np


class RankBits:
    """A bit vector with ranks: words of 64 bits and the count of ones before each."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int32)]).astype(np.int32)
        self.ones = int(self.before[-1])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below).astype(np.int32)


class WaveletMatrix:
    """Symbols as bit planes, the highest first; each plane parts the zeros from the ones, stably."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.planes: list[tuple[int, RankBits, int]] = []
        for k in range(bits - 1, -1, -1):
            plane = ((symbols >> k) & 1).astype(np.uint8)
            self.planes.append((k, RankBits(plane), len(plane) - int(plane.sum())))
            symbols = np.concatenate([symbols[plane == 0], symbols[plane == 1]])

    def rank(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How often each symbol stands before ``low`` and before ``high``."""
        start = np.zeros_like(low)
        for k, bits, zeros in self.planes:
            one = ((symbol >> k) & 1).astype(bool)
            a, b, s = bits.rank(low), bits.rank(high), bits.rank(start)
            low, high, start = np.where(one, zeros + a, low - a), np.where(one, zeros + b, high - b), np.where(one, zeros + s, start - s)
        return low - start, high - start


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` symbols or more, by prefix doubling; ties by place."""
    rank, n, step = text.astype(np.int64), len(text), 1
    order = np.argsort(rank, kind="stable")
    while True:
        if step >= depth or n < 2:
            return order
        second = np.full(n, -1, np.int64)
        second[: n - step] = rank[step:]
        key = rank * (n + 1) + second + 1
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        new = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = new
        step *= 2


class FMIndex:
    """An index of ``text`` (symbols 0..size-1; 0 parts the texts) that counts occurrences of patterns of ``depth`` symbols at most.

    ``depth`` bounds the sort: suffixes alike in their first ``depth`` symbols form one interval for every such pattern, in any order.
    """

    def __init__(self, text: np.ndarray, depth: int):
        bits = max(1, int(text.max(initial=0)).bit_length())
        order = suffix_array(text, depth)
        self.bwt = WaveletMatrix(text[order - 1], bits)
        counts = np.bincount(text, minlength=(1 << bits) + 1)
        self.first = np.concatenate([[0], np.cumsum(counts)])
        self.size = len(text)

    def backward(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix intervals after one more symbol on the left."""
        a, b = self.bwt.rank(symbol, low, high)
        return self.first[symbol] + a, self.first[symbol] + b

    def matching_statistics(self, text: np.ndarray, ends: np.ndarray, most: int, least: int = 2) -> np.ndarray:
        """For each end (exclusive) in ``text``: the length, ``most`` at most, of the longest match ending there that occurs ``least`` times or more."""
        out = np.zeros(len(ends), np.int32)
        live = np.arange(len(ends))
        low, high = np.zeros(len(ends), np.int64), np.full(len(ends), self.size, np.int64)
        for step in range(1, most + 1):
            at = ends[live] - step
            ok = at >= 0
            live, low, high, at = live[ok], low[ok], high[ok], at[ok]
            symbol = text[at].astype(np.int64)
            low, high = self.backward(symbol, low, high)
            ok = (high - low >= least) & (symbol != 0)
            live, low, high = live[ok], low[ok], high[ok]
            if not len(live):
                break
            out[live] = step
        return out
