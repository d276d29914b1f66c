"""Monotone sequences in Elias-Fano form, with access and successor search by select, and codes of real numbers.

A value's high part is a unary gap in a bit sequence, its low part a few packed
bits. Everything is vectorised over queries and reads only what a query needs:
a select finds the values that share the key's high part, and a binary search
among their low parts gives the successor. Where values are a parent's number
and 32 bits of a child, and the low part has these bits, the unary gaps are
the monotone pointers from parents to their children, and the search is one
among the children of the key's parent. Parts are plain arrays, so a sequence can lie in any buffer, a mapped one too.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64
#: Queries worked on at a time.
BLOCK = 1 << 16


def _select_table() -> np.ndarray:
    """Position of the k-th set bit in each byte."""
    out = np.zeros((256, 8), dtype=np.uint8)
    for byte in range(256):
        at = [b for b in range(8) if byte >> b & 1]
        out[byte, : len(at)] = at
    return out


_SELECT = _select_table()


class Bits:
    """A bit sequence in little-endian words, with a directory of the ones before each word."""

    def __init__(self, words: np.ndarray) -> None:
        self.words = words
        ones = np.zeros(len(words) + 1, dtype=np.int64)
        np.cumsum(np.bitwise_count(words), out=ones[1:])
        self.before = (np.arange(len(words) + 1) * 64 - ones, ones)

    def select(self, k: np.ndarray, bit: int) -> np.ndarray:
        """Position of the k-th (from 0) bit of that value; there must be one."""
        before = self.before[bit]
        word = np.searchsorted(before, k, side="right") - 1
        left = k - before[word]
        raw = self.words[word]
        octets = (raw if bit else ~raw).view(np.uint8).reshape(-1, 8)
        upto = np.cumsum(np.bitwise_count(octets), axis=1, dtype=np.uint8)
        at = (upto <= left[:, None]).sum(1)
        row = np.arange(len(k))
        left = left - np.where(at > 0, upto[row, at - 1], 0)
        return word * 64 + at * 8 + _SELECT[octets[row, at], left]

    def next_zero(self, k: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Position of the k-th zero, given that of the one before it or -1."""
        word = (at + 1) >> 6
        rest = ~self.words[word] >> ((at + 1) & 63).astype(U64)
        out = at + 1 + np.bitwise_count((rest & (~rest + U64(1))) - U64(1))
        far = np.flatnonzero(rest == 0)
        if len(far):
            out[far] = self.select(k[far], 0)
        return out


class EliasFano:
    """A non-decreasing sequence in about log2(universe / n) + 2 bits a value."""

    MOST_LOW = 56

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray) -> None:
        self.n, self.low_bits, self.low, self.high = n, low_bits, low, Bits(high)
        self._wide = np.ndarray((max(len(low) - 7, 0),), dtype=">u8", buffer=low, strides=(1,)) if low_bits and n else None

    @classmethod
    def of(cls, values: np.ndarray, universe: int, low_bits: int | None = None) -> EliasFano:
        """values ascending, all below universe; low_bits: of the low part, by default as many as take the least space."""
        n, values = len(values), values.astype(U64)
        bits = min(max(0, (universe // max(n, 1)).bit_length() - 1), cls.MOST_LOW) if low_bits is None else low_bits
        low = np.zeros(8, dtype=np.uint8)
        if bits and n:
            rows = np.unpackbits(values.astype(">u8").view(np.uint8).reshape(n, 8), axis=1)[:, 64 - bits :]
            low = np.r_[np.packbits(rows), low]
        marks = np.zeros(n + ((universe - 1) >> bits) + 2, dtype=bool)
        marks[(values >> U64(bits)).astype(np.int64) + np.arange(n)] = True
        packed = np.packbits(marks, bitorder="little")
        high = np.zeros(-(-len(packed) // 8), dtype=U64)
        high.view(np.uint8)[: len(packed)] = packed
        return cls(n, bits, low, high)

    def parts(self) -> list[np.ndarray]:
        return [np.array([self.n, self.low_bits], dtype=np.int64), self.low, self.high.words]

    @classmethod
    def read(cls, parts: list[np.ndarray]) -> EliasFano:
        return cls(int(parts[0][0]), int(parts[0][1]), parts[1], parts[2])

    def _low(self, index: np.ndarray) -> np.ndarray:
        if self._wide is None:
            return np.zeros(len(index), dtype=U64)
        bit = index * self.low_bits
        raw = self._wide[bit >> 3].astype(U64)
        return (raw << (bit & 7).astype(U64)) >> U64(64 - self.low_bits)

    def access(self, index: np.ndarray) -> np.ndarray:
        """The values at some indices."""
        out = np.empty(len(index), dtype=U64)
        for a in range(0, len(index), BLOCK):
            i = index[a : a + BLOCK]
            out[a : a + BLOCK] = ((self.high.select(i, 1) - i).astype(U64) << U64(self.low_bits)) | self._low(i)
        return out

    def _search(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the first value that is no less, n if there is none, and whether it equals the key."""
        high = (keys >> U64(self.low_bits)).astype(np.int64)
        before = np.where(high > 0, self.high.select(np.maximum(high - 1, 0), 0), -1)
        first = before - (high - 1)
        first[high == 0] = 0
        last = self.high.next_zero(high, before) - high
        want = keys & U64((1 << self.low_bits) - 1)
        end, live = last.copy(), np.flatnonzero(first < last)
        while len(live):
            lo, hi = first[live], last[live]
            middle = (lo + hi) >> 1
            less = self._low(middle) < want[live]
            lo, hi = np.where(less, middle + 1, lo), np.where(less, hi, middle)
            first[live], last[live] = lo, hi
            live = live[lo < hi]
        same = first < end
        same[same] = self._low(first[same]) == want[same]
        return first, same

    def successors(self, keys: np.ndarray) -> np.ndarray:
        """For each key the index of the first value that is no less, n if there is none."""
        return self._each(keys)[0]

    def find(self, keys: np.ndarray) -> np.ndarray:
        """For each key its index, -1 if it isn't there."""
        at, same = self._each(keys)
        return np.where(same, at, -1)

    def _each(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at, same = np.empty(len(keys), dtype=np.int64), np.empty(len(keys), dtype=bool)
        for a in range(0, len(keys), BLOCK):
            at[a : a + BLOCK], same[a : a + BLOCK] = self._search(keys[a : a + BLOCK].astype(U64))
        return at, same


class Codes:
    """Sixteen-bit codes of numbers between the least and the greatest."""

    def __init__(self, low: float, step: float, codes: np.ndarray) -> None:
        self.low, self.step, self.codes = low, step, codes

    @classmethod
    def of(cls, values: np.ndarray) -> Codes:
        low, high = (float(values.min()), float(values.max())) if len(values) else (0.0, 0.0)
        step = (high - low) / 65535 or 1.0
        return cls(low, step, np.rint((values - low) / step).astype(np.uint16))

    def __call__(self, index: np.ndarray) -> np.ndarray:
        return self.low + self.step * self.codes[index]

    def parts(self) -> list[np.ndarray]:
        return [np.array([self.low, self.step]), self.codes]

    @classmethod
    def read(cls, parts: list[np.ndarray]) -> Codes:
        return cls(float(parts[0][0]), float(parts[0][1]), parts[1])
