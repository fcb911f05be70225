"""A compressed FM-index of word sequences: the Burrows-Wheeler transform in a wavelet matrix of packed bits."""

from __future__ import annotations

import numpy as np

from lociflow.llm.common import U64


class Bits:
    """A bit vector with counts of ones before any place."""

    def __init__(self, bits: np.ndarray):
        words = np.packbits(bits, bitorder="little")
        words = np.concatenate((words, np.zeros(16 - len(words) % 8, np.uint8))).view(np.uint64)
        self.words = words
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64))).astype(np.int32)

    def ones(self, i: np.ndarray) -> np.ndarray:
        w = i >> 6
        return self.before[w] + np.bitwise_count(self.words[w] & ((U64(1) << (i & 63).astype(np.uint64)) - U64(1)))


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Rotations of the text by their first `depth` symbols at least, by prefix doubling."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    order, k = np.argsort(rank, kind="stable"), 1
    while k < depth and rank.max() < n - 1:
        key = rank * (n + 1) + np.roll(rank, -k)
        order = np.argsort(key, kind="stable")
        new = np.ones(n, np.int64)
        new[0] = 0
        new[1:] = key[order[1:]] != key[order[:-1]]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new)
        k *= 2
    return order


class FmIndex:
    """Over a text of symbols 0 .. sigma - 1; counts patterns of up to `depth` symbols, each place by its weight."""

    def __init__(self, text: np.ndarray, sigma: int, depth: int, weight: np.ndarray | None = None):
        order = suffix_order(text, depth)
        self.before = np.concatenate(([0], np.cumsum(weight[order]))) if weight is not None else np.arange(len(text) + 1)
        bwt = text[order - 1]
        self.size = len(text)
        self.less = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=sigma))))
        self.levels: list[tuple[int, Bits, int]] = []
        for shift in range(max(1, int(sigma - 1).bit_length()) - 1, -1, -1):
            bit = (bwt >> shift) & 1
            self.levels.append((shift, Bits(bit.astype(bool)), int(len(bit) - bit.sum())))
            bwt = np.concatenate((bwt[bit == 0], bwt[bit == 1]))
        self.base = self._down(np.arange(sigma), np.zeros(sigma, np.int64))

    def _down(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for shift, bits, zeros in self.levels:
            ones = bits.ones(i)
            i = np.where((symbol >> shift) & 1, zeros + ones, i - ones)
        return i

    def count(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return self.before[high] - self.before[low]

    def backward(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the patterns that begin with `symbol` and go on with those of [low, high)."""
        start = self.less[symbol] - self.base[symbol]
        both = self._down(np.concatenate((symbol, symbol)), np.concatenate((low, high)))
        return start + both[: len(symbol)], start + both[len(symbol) :]
