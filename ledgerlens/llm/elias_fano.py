"""Elias-Fano sequences: monotone numbers in little more than their entropy, searched without unpacking."""

from __future__ import annotations

import numpy as np

from ledgerlens.llm.common import by_value

by_value(__name__)

# SELECT[byte, k]: place of the k-th set bit of a byte; ONES: how many a byte has.
BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(bool)
ONES = BITS.sum(1).astype(np.int64)
SELECT = np.array([np.append(np.flatnonzero(row), [8] * (8 - row.sum())) for row in BITS], np.int64)


def packed(values: np.ndarray, width: int) -> np.ndarray:
    """Numbers of ``width`` bits, end to end in 64-bit words (one word of padding)."""
    out = np.zeros(len(values) * width // 64 + 2, np.uint64)
    if not width or not len(values):
        return out
    bit = np.arange(len(values), dtype=np.int64) * width
    word, shift = bit >> 6, (bit & 63).astype(np.uint64)
    values = values.astype(np.uint64)
    # Numbers that begin in one word are next to each other.
    first, begin = np.unique(word, return_index=True)
    out[first] |= np.bitwise_or.reduceat(values << shift, begin)
    over = (shift + np.uint64(width)) > np.uint64(64)
    out[word[over] + 1] |= values[over] >> (np.uint64(64) - shift[over])
    return out


def unpacked(words: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    if not width:
        return np.zeros(len(at), np.uint64)
    bit = at.astype(np.int64) * width
    word, shift = bit >> 6, (bit & 63).astype(np.uint64)
    low = words[word] >> shift
    high = np.where(shift > 0, words[word + 1] << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
    return (low | high) & np.uint64(2**width - 1)


class EliasFano:
    """A sequence that does not fall: low bits packed, high bits in unary.

    The ones and zeros before each word of high bits are part of what is
    written, so that a mapped file is opened without being read.
    """

    def __init__(self, n: int, width: int, lows: np.ndarray, highs: np.ndarray, ones: np.ndarray, zeros: np.ndarray):
        self.n, self.width, self.lows, self.highs, self.ones, self.zeros = n, width, lows, highs, ones, zeros

    @classmethod
    def build(cls, values: np.ndarray, universe: int) -> EliasFano:
        n = len(values)
        width = max(0, (max(1, universe) // max(1, n)).bit_length() - 1)
        values = values.astype(np.uint64)
        high = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
        size = int(((universe >> width) + n) // 64 + 2)
        highs = np.zeros(size * 8, np.uint8)
        flags = np.zeros(size * 64, bool)
        flags[high] = True
        highs = np.packbits(flags, bitorder="little").view(np.uint64)
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(highs).astype(np.int64))])
        zeros = np.arange(len(ones), dtype=np.int64) * 64 - ones
        return cls(n, width, packed(values & np.uint64(2**width - 1), width), highs, ones, zeros)

    def arrays(self) -> list[np.ndarray]:
        head = np.array([self.n, self.width, len(self.lows), len(self.highs)], np.uint64)
        return [head, self.lows, self.highs, self.ones.view(np.uint64), self.zeros.view(np.uint64)]

    @classmethod
    def read(cls, words: np.ndarray) -> tuple[EliasFano, int]:
        """A sequence from the start of ``words``, and how many words it takes."""
        n, width, lows, highs = (int(x) for x in words[:4])
        edges = np.cumsum([4, lows, highs, highs + 1, highs + 1]).tolist()
        low, high, ones, zeros = (words[a:b] for a, b in zip(edges[:-1], edges[1:]))
        return cls(n, width, low, high, ones.view(np.int64), zeros.view(np.int64)), edges[-1]

    def select(self, k: np.ndarray, ones: bool) -> np.ndarray:
        """Place of the k-th one, or zero, of the high bits."""
        before = self.ones if ones else self.zeros
        word = np.searchsorted(before, k, side="right") - 1
        rest = k - before[word]
        bits = self.highs[word] if ones else ~self.highs[word]
        place = word * 64
        done = np.zeros(len(k), bool)
        for byte in range(8):
            part = ((bits >> np.uint64(8 * byte)) & np.uint64(255)).astype(np.int64)
            count = ONES[part]
            here = ~done & (rest < count)
            place[here] += 8 * byte + SELECT[part[here], rest[here]]
            done |= here
            rest = np.where(done, rest, rest - count)
        return place

    def get(self, at: np.ndarray) -> np.ndarray:
        at = at.astype(np.int64)
        high = (self.select(at, True) - at).astype(np.uint64)
        return (high << np.uint64(self.width)) | unpacked(self.lows, at, self.width)

    def find(self, values: np.ndarray) -> np.ndarray:
        """Where each value is, or -1: the range of its high bits, then a search among the low bits."""
        values = values.astype(np.uint64)
        if not self.n or not len(values):
            return np.full(len(values), -1, np.int64)
        high = (values >> np.uint64(self.width)).astype(np.int64)
        high = np.minimum(high, int(self.zeros[-1]) - 1)
        begin = np.where(high > 0, self.select(np.maximum(high - 1, 0), False) + 1 - high, 0)
        end = self.select(high, False) - high
        low = values & np.uint64(2**self.width - 1)
        left, right = begin.copy(), end.copy()
        while True:
            live = left < right
            if not live.any():
                break
            middle = (left + right) >> 1
            less = unpacked(self.lows, np.minimum(middle, self.n - 1), self.width) < low
            left = np.where(live & less, middle + 1, left)
            right = np.where(live & ~less, middle, right)
        at = np.minimum(left, self.n - 1)
        same = (left < end) & (unpacked(self.lows, at, self.width) == low)
        same &= (values >> np.uint64(self.width)).astype(np.int64) == high
        return np.where(same, left, -1)
