"""Elias-Fano sequences and the two-level n-gram trie built of them, all queries vectorised."""

from __future__ import annotations

import numpy as np


class EliasFano:
    """A non-decreasing sequence of non-negative numbers, about 2 + log2(universe / length) bits each.

    The low bits lie packed one after the other; the high bits are unary: one bit for each element, a zero after each
    high value. A directory of ones before each 64-bit word answers rank and select. All parts are flat buffers that
    can be read in place (memory-mapped or inside an Arrow buffer)."""

    def __init__(self, values: np.ndarray, universe: int):
        n = len(values)
        self.n, self.low = n, max(0, int(universe // max(n, 1)).bit_length() - 1)
        v = np.asarray(values, np.uint64)
        high = (v >> np.uint64(self.low)).astype(np.int64)
        self.top = int(universe >> self.low) + 1
        bits = np.zeros(-(-(n + self.top + 1) // 64) * 64, np.uint8)
        bits[high + np.arange(n)] = 1
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        per = np.bitwise_count(self.words).astype(np.int64)
        self.ones = np.r_[0, np.cumsum(per)]
        self.zeros = np.arange(len(self.ones)) * 64 - self.ones
        self.lows = np.zeros(-(-n * self.low // 8) + 8, np.uint8)
        if self.low:
            one = (v[:, None] >> np.arange(self.low, dtype=np.uint64)) & np.uint64(1)
            packed = np.packbits(one.astype(np.uint8).reshape(-1), bitorder="little")
            self.lows[:len(packed)] = packed

    def nbytes(self) -> int:
        return self.words.nbytes + self.lows.nbytes + self.ones.nbytes

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low:
            return np.zeros(len(i), np.uint64)
        at = i * self.low
        chunk = np.zeros(len(i), np.uint64)
        for k in range(8):
            chunk |= self.lows[np.minimum((at >> 3) + k, len(self.lows) - 1)].astype(np.uint64) << np.uint64(8 * k)
        return (chunk >> (at & 7).astype(np.uint64)) & np.uint64((1 << self.low) - 1)

    def _select(self, k: np.ndarray, directory: np.ndarray, flip: bool) -> np.ndarray:
        """Position of the k-th (from 0) one, or zero if ``flip``, in the high bits."""
        w = np.searchsorted(directory, k, side="right") - 1
        word = ~self.words[w] if flip else self.words[w]
        left, at = (k - directory[w]).copy(), np.zeros(len(k), np.int64)
        for step in (32, 16, 8, 4, 2, 1):  # halve the word: is the wanted bit in its lower part?
            part = word & np.uint64((1 << step) - 1)
            count = np.bitwise_count(part).astype(np.int64)
            right = left >= count
            left -= np.where(right, count, 0)
            at += np.where(right, step, 0)
            word = np.where(right, word >> np.uint64(step), part)
        return w * 64 + at

    def get(self, i: np.ndarray) -> np.ndarray:
        i = np.asarray(i, np.int64)
        high = self._select(i, self.ones, False) - i
        return (high.astype(np.uint64) << np.uint64(self.low)) | self._low(i)

    def successor(self, x: np.ndarray) -> np.ndarray:
        """Index of the first element that is not below x (the length if there is none)."""
        x = np.asarray(x, np.uint64)
        high = (x >> np.uint64(self.low)).astype(np.int64)
        # elements with a smaller high part stand before the (high - 1)-th zero
        lo = np.where(high > 0, self._select(np.maximum(high - 1, 0), self.zeros, True) - np.maximum(high - 1, 0), 0)
        hi = self._select(high, self.zeros, True) - high
        end, want = hi.copy(), x & np.uint64((1 << self.low) - 1)
        while True:  # among those with the same high part the low parts ascend
            open_ = lo < hi
            if not open_.any():
                return np.minimum(lo, end)
            mid = (lo + hi) >> 1
            less = open_ & (self._low(np.minimum(mid, max(self.n - 1, 0))) < want)
            lo, hi = np.where(less, mid + 1, lo), np.where(open_ & ~less, mid, hi)


class BigramTrie:
    """Contexts 0..C-1, each with its successors ascending.

    Level 1 points into level 2 (monotone, Elias-Fano). Level 2 holds the successors; a word stands there relative to
    its context, as context * words + word, which ascends over the whole level, so one Elias-Fano sequence serves all
    contexts. A probability for each successor and a back-off weight for each context are 16-bit codes."""

    def __init__(self, context: np.ndarray, word: np.ndarray, log_p: np.ndarray, backoff: np.ndarray, words: int):
        self.width, contexts = words, len(backoff)
        self.pointers = EliasFano(np.searchsorted(context, np.arange(contexts + 1)), len(word))
        self.successors = EliasFano(context.astype(np.uint64) * np.uint64(words) + word.astype(np.uint64), contexts * words)
        self.probability, self.backoff = quantise(log_p), quantise(backoff)

    def score(self, context: np.ndarray, word: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """log10 probability of each word after its context; ``lower`` is that without context, for unseen pairs."""
        begin, end = self.pointers.get(context).astype(np.int64), self.pointers.get(context + 1).astype(np.int64)
        wanted = context.astype(np.uint64) * np.uint64(self.width) + word.astype(np.uint64)
        at = np.clip(self.successors.successor(wanted), begin, end)
        out = dequantise(self.backoff[context]) + lower
        inside = np.flatnonzero(at < end)
        hit = inside[self.successors.get(at[inside]) == wanted[inside]]
        out[hit] = dequantise(self.probability[at[hit]])
        return out


#: log10 values from LEAST to 0 in 65,536 even steps.
LEAST = -16.0


def quantise(log10: np.ndarray) -> np.ndarray:
    return np.rint(np.clip(log10 / LEAST, 0, 1) * 65535).astype("<u2")


def dequantise(code: np.ndarray) -> np.ndarray:
    return code.astype(np.float64) * (LEAST / 65535)
