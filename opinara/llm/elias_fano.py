"""A compact n-gram trie: Elias-Fano levels and pointers, quantised values, in one memory-mapped file."""

from __future__ import annotations

import tempfile
from collections.abc import Sequence

import numpy as np

BYTE = np.arange(256, dtype=np.uint8)
ONES = np.bitwise_count(BYTE).astype(np.int64)
# SELECT[b, r] is the place of the r-th set bit of byte b.
SELECT = np.array([[*[k for k in range(8) if b >> k & 1], *[8] * 8][:8] for b in range(256)], dtype=np.int64)


class MappedArrays:
    """Arrays in an unlinked temporary file; the system may drop their pages at any time."""

    def __init__(self) -> None:
        self.file = tempfile.TemporaryFile()

    def keep(self, values: np.ndarray) -> np.ndarray:
        if not len(values):
            return values
        offset = self.file.seek(0, 2)
        self.file.write(np.ascontiguousarray(values).tobytes())
        self.file.flush()
        return np.memmap(self.file, dtype=values.dtype, mode="r", offset=offset, shape=values.shape)


class EliasFano:
    """A non-decreasing sequence below ``universe``: the low bits packed, the high bits as gaps in unary."""

    def __init__(self, values: np.ndarray, universe: int, arrays: MappedArrays):
        self.count = len(values)
        self.low_bits = max(0, (universe // max(self.count, 1)).bit_length() - 1)
        values = values.astype(np.uint64)
        high = (values >> np.uint64(self.low_bits)).astype(np.int64)
        size = self.count + (universe >> self.low_bits) + 1
        bits = np.zeros(-(-size // 64) * 64, dtype=np.uint8)
        bits[high + np.arange(self.count)] = 1
        words = np.packbits(bits, bitorder="little").view(np.uint64)
        self.high = arrays.keep(words)
        ones = np.bitwise_count(words).astype(np.int64)
        self.ones = arrays.keep(np.concatenate([[0], np.cumsum(ones)]))
        self.zeros = arrays.keep(np.concatenate([[0], np.cumsum(64 - ones)]))
        self.mask = np.uint64((1 << self.low_bits) - 1)
        self.low = arrays.keep(self.packed(values & self.mask))

    def packed(self, low: np.ndarray) -> np.ndarray:
        parts, step = [], 1 << 16
        for at in range(0, len(low) if self.low_bits else 0, step):
            chunk = np.ascontiguousarray(low[at : at + step]).view(np.uint8).reshape(-1, 8)
            parts.append(np.packbits(np.unpackbits(chunk, axis=1, bitorder="little")[:, : self.low_bits].ravel(), bitorder="little"))
        whole = np.concatenate([*parts, np.zeros(16, dtype=np.uint8)])
        return np.concatenate([whole, np.zeros(-len(whole) % 8, dtype=np.uint8)]).view(np.uint64)

    def lows(self, places: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(places), dtype=np.uint64)
        bit = places * self.low_bits
        word, off = bit >> 6, (bit & 63).astype(np.uint64)
        value = self.low[word] >> off
        beyond = np.where(off > 0, self.low[word + 1] << ((np.uint64(64) - off) & np.uint64(63)), np.uint64(0))
        return (value | beyond) & self.mask

    def select(self, ranks: np.ndarray, zeros: bool) -> np.ndarray:
        """Places of the set (or unset) bits of given 0-based ranks among the high bits."""
        before = self.zeros if zeros else self.ones
        word = np.searchsorted(before, ranks, side="right") - 1
        rest = ranks - before[word]
        bits = ~self.high[word] if zeros else np.asarray(self.high[word])
        octets = np.ascontiguousarray(bits).view(np.uint8).reshape(-1, 8)
        reached = np.cumsum(ONES[octets], axis=1)
        byte = (reached <= rest[:, None]).sum(axis=1)
        row = np.arange(len(ranks))
        rest = rest - np.where(byte > 0, reached[row, np.maximum(byte - 1, 0)], 0)
        return word * 64 + byte * 8 + SELECT[octets[row, byte], rest]

    def get(self, places: np.ndarray) -> np.ndarray:
        high = (self.select(places, zeros=False) - places).astype(np.uint64)
        return high << np.uint64(self.low_bits) | self.lows(places)

    def below(self, high: np.ndarray) -> np.ndarray:
        """How many values have high bits below the given ones."""
        found = np.zeros(len(high), dtype=np.int64)
        some = high > 0
        if some.any():
            found[some] = self.select(high[some] - 1, zeros=True) - (high[some] - 1)
        return found

    def successor(self, values: np.ndarray) -> np.ndarray:
        """Place of the first value that is not less; the count if there is none. Values must be below the universe."""
        values = values.astype(np.uint64)
        high, low = (values >> np.uint64(self.low_bits)).astype(np.int64), values & self.mask
        start, end = self.below(high), self.below(high + 1)
        while (open_ := np.flatnonzero(start < end)).size:
            middle = (start[open_] + end[open_]) // 2
            less = self.lows(middle) < low[open_]
            start[open_[less]] = middle[less] + 1
            end[open_[~less]] = middle[~less]
        return start

    def find(self, values: np.ndarray) -> np.ndarray:
        """Place of each value, -1 if it is not in the sequence."""
        if not self.count or not len(values):
            return np.full(len(values), -1, dtype=np.int64)
        place = self.successor(values)
        found = np.minimum(place, self.count - 1)
        return np.where((place < self.count) & (self.get(found) == values.astype(np.uint64)), found, -1)


WORD_BITS = 32


class NgramTrie:
    """N-grams of word numbers below 2^32 with a value for each, one Elias-Fano sequence per level.

    A word is kept relative to its context: under the context of rank r of the level above it becomes r * 2^32 + word,
    which makes the whole level monotone. Pointers to the first successor of each context are monotone, too.
    """

    def __init__(self, ngrams: Sequence[np.ndarray], values: np.ndarray):
        """``ngrams`` has a column of words for each level, in lexicographic order without repeats."""
        arrays = MappedArrays()
        self.levels: list[EliasFano] = []
        self.pointers: list[EliasFano] = []
        self.values = arrays.keep(values)
        rows = len(values)
        context = np.zeros(rows, dtype=np.int64)
        starts = np.zeros(min(rows, 1), dtype=np.int64)
        for depth, words in enumerate(ngrams):
            new = np.ones(rows, dtype=bool)
            if rows:
                new[1:] = (context[1:] != context[:-1]) | (words[1:] != words[:-1])
            first = np.flatnonzero(new)
            relative = context[first].astype(np.uint64) << np.uint64(WORD_BITS) | words[first].astype(np.uint64)
            self.levels.append(EliasFano(relative, max(len(starts), 1) << WORD_BITS, arrays))
            if depth:
                pointer = np.concatenate([np.searchsorted(first, starts), [len(first)]])
                self.pointers.append(EliasFano(pointer, len(first) + 1, arrays))
            context, starts = np.cumsum(new) - 1, first

    def find(self, ngrams: Sequence[np.ndarray]) -> np.ndarray:
        """Place of each n-gram among the values, -1 if absent; every level looks only below its own context."""
        rank = np.zeros(len(ngrams[0]), dtype=np.int64)
        for depth, words in enumerate(ngrams):
            held = np.flatnonzero(rank >= 0)
            relative = rank[held].astype(np.uint64) << np.uint64(WORD_BITS) | words[held].astype(np.uint64)
            rank[held] = self.levels[depth].find(relative)
        return rank

    def successors(self, depth: int, ranks: np.ndarray) -> np.ndarray:
        """How many different words follow each context of a level."""
        pointer = self.pointers[depth]
        return (pointer.get(ranks + 1) - pointer.get(ranks)).astype(np.int64)
