"""Elias-Fano sequences over arrays that may be memory-mapped, with vectorised successor search."""

from __future__ import annotations

import numpy as np

_EACH, _TOPS, _BYTE, _EIGHT = (np.uint64(x) for x in (0x0101010101010101, 0x8080808080808080, 255, 8))
_PAIRS, _FOURS, _NIBBLES = (np.uint64(x) for x in (0x5555555555555555, 0x3333333333333333, 0x0F0F0F0F0F0F0F0F))
#: The place of a byte's r-th one, at byte * 8 + r.
_PLACES = np.array([(*(i for i in range(8) if b >> i & 1), *(7,) * 8)[:8] for b in range(256)], dtype=np.uint8).ravel()


def encode(values: np.ndarray, universe: int) -> dict[str, np.ndarray]:
    """Arrays of an ascending sequence below ``universe``: low bits packed, high bits in unary with a count of zeros by word."""
    n = len(values)
    width = max(0, (universe // max(1, n)).bit_length() - 1)
    values = values.astype(np.uint64)
    high = (values >> np.uint64(width)).astype(np.int64)
    buckets = int((universe >> width) + 1)
    ones = high + np.arange(n)
    words = np.zeros((n + buckets + 63) // 64 + 1, dtype=np.uint64)
    np.bitwise_or.at(words, ones >> 6, np.uint64(1) << (ones & 63).astype(np.uint64))
    low = np.zeros(n * width // 64 + 2, dtype=np.uint64)
    if width:
        bits = values & np.uint64((1 << width) - 1)
        at = np.arange(n, dtype=np.int64) * width
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        np.bitwise_or.at(low, word, bits << shift)
        over = shift.astype(np.int64) + width > 64
        np.bitwise_or.at(low, word[over] + 1, bits[over] >> (np.uint64(64) - shift[over]))
    zeros = np.concatenate(([0], np.cumsum(64 - np.bitwise_count(words).astype(np.int64))))[:-1]
    return {"head": np.array([n, width], dtype=np.uint64), "high": words, "zeros": zeros, "low": low}


def _one(words: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The place of each word's ``rank``-th one: its byte by the bytes' running counts, then by a table."""
    rank = rank.astype(np.uint64)
    ones = words - ((words >> np.uint64(1)) & _PAIRS)
    ones = (ones & _FOURS) + ((ones >> np.uint64(2)) & _FOURS)
    ones = ((ones + (ones >> np.uint64(4))) & _NIBBLES) * _EACH
    before = np.bitwise_count(((rank * _EACH | _TOPS) - ones) & _TOPS).astype(np.uint64)  # bytes whose running count is at most the rank
    shift = np.minimum(before, np.uint64(7)) << np.uint64(3)
    inner = (rank - (((ones << _EIGHT) >> shift) & _BYTE)) & np.uint64(7)
    byte = (words >> shift) & _BYTE
    return shift.astype(np.int64) + _PLACES[((byte << np.uint64(3)) | inner).astype(np.int64)]


class Sequence:
    def __init__(self, arrays: dict[str, np.ndarray]):
        self.n, self.width = (int(x) for x in arrays["head"])
        self.high, self.zeros, self.low = arrays["high"], arrays["zeros"], arrays["low"]

    def _zero(self, k: np.ndarray) -> np.ndarray:
        """Places of the k-th zeros."""
        word = np.searchsorted(self.zeros, k, side="right") - 1
        return (word << 6) + _one(~self.high[word], k - self.zeros[word])

    def _next_zero(self, at: np.ndarray) -> np.ndarray:
        """Places of the first zeros behind ``at``."""
        at = at + 1
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        left = ~self.high[word] >> bit
        out = at + np.bitwise_count((left & (~left + np.uint64(1))) - np.uint64(1)).astype(np.int64)
        far = np.flatnonzero(left == 0)  # the zero lies in a later word
        if len(far):
            out[far] = self._zero(self.zeros[word[far] + 1])
        return out

    def _lows(self, i: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(i), dtype=np.uint64)
        at = i * self.width
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        value = self.low[word] >> shift
        over = shift > 64 - self.width
        value[over] |= self.low[word[over] + 1] << (np.uint64(64) - shift[over])
        return value & np.uint64((1 << self.width) - 1)

    def _ones(self, i: np.ndarray) -> np.ndarray:
        """Places of the i-th ones."""
        ones = np.arange(len(self.zeros)) * 64 - self.zeros
        word = np.searchsorted(ones, i, side="right") - 1
        return (word << 6) + _one(self.high[word], i - ones[word])

    def _valued(self, i: np.ndarray, at: np.ndarray) -> np.ndarray:
        return (((at - i).astype(np.uint64) << np.uint64(self.width)) | self._lows(i)).astype(np.int64)

    def get(self, i: np.ndarray) -> np.ndarray:
        """The i-th values."""
        return self._valued(i, self._ones(i))

    def both(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The i-th values and the next ones."""
        at = self._ones(i)
        word, bit = (at + 1) >> 6, ((at + 1) & 63).astype(np.uint64)
        left = self.high[word] >> bit
        follow = at + 1 + np.bitwise_count((left & (~left + np.uint64(1))) - np.uint64(1)).astype(np.int64)
        far = np.flatnonzero(left == 0)  # the next one lies in a later word
        if len(far):
            follow[far] = self._ones(i[far] + 1)
        return self._valued(i, at), self._valued(i + 1, follow)

    def find(self, x: np.ndarray, first: np.ndarray | int = 0, stop: np.ndarray | None = None) -> np.ndarray:
        """The place of each value within [first, stop), or -1: the successor among the values that share its high bits, if equal."""
        out = np.full(len(x), -1, dtype=np.int64)
        if not self.n or not len(x):
            return out
        h, want = (x >> np.uint64(self.width)).astype(np.int64), x & np.uint64((1 << self.width) - 1)
        before = np.where(h > 0, self._zero(np.maximum(h - 1, 0)), -1)
        lo, hi = before - h + 1, self._next_zero(before) - h
        lo, hi = np.maximum(lo, first), hi if stop is None else np.minimum(hi, stop)
        live = np.flatnonzero(lo < hi)
        lo, hi, want = lo[live], hi[live], want[live]
        while len(live):
            middle = (lo + hi) >> 1
            low = self._lows(middle)
            out[live[low == want]] = middle[low == want]
            lo, hi = np.where(low < want, middle + 1, lo), np.where(low < want, hi, middle)
            more = (lo < hi) & (low != want)
            live, lo, hi, want = live[more], lo[more], hi[more], want[more]
        return out
