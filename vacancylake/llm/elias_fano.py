"""Elias-Fano coded ascending numbers, searched as numpy arrays without being decoded.

Of n numbers below a universe U each keeps its low log2(U / n) bits in a packed array; the high parts are written in unary as
one bit string, about two bits per number. ``successor`` finds, for many targets at once, the first number at or above each.

Cases: no numbers give arrays in which nothing is found; targets beyond the last number have no successor; numbers that do not ascend
strictly are the caller's error.
"""

from __future__ import annotations

import numpy as np

_ONES = np.uint64(0xFFFFFFFFFFFFFFFF)
#: 1 and 128 in every byte of a word.
_EACH, _TOP = np.uint64(0x0101010101010101), np.uint64(0x8080808080808080)
#: _SELECT[256 * r + b]: the place of the bit r (from 0) among those set in the byte b.
_SELECT = np.array([[([k for k in range(8) if b >> k & 1] + [8] * 8)[r] for b in range(256)] for r in range(8)], np.uint8).ravel()


def encode(values: np.ndarray, universe: int) -> dict[str, np.ndarray]:
    """Arrays that ``Sequence`` reads; ``values`` ascend strictly and are below ``universe``."""
    n = len(values)
    values = values.astype(np.uint64)
    low_bits = max(0, int(universe // max(n, 1)).bit_length() - 1)
    low = np.zeros(-(-n * low_bits // 64) + 2, np.uint64)
    if low_bits and n:
        part = values & np.uint64((1 << low_bits) - 1)
        bit = np.arange(n, dtype=np.uint64) * np.uint64(low_bits)
        word, shift = (bit >> np.uint64(6)).astype(np.int64), bit & np.uint64(63)
        np.bitwise_or.at(low, word, part << shift)
        over = np.flatnonzero(shift + np.uint64(low_bits) > np.uint64(64))
        np.bitwise_or.at(low, word[over] + 1, part[over] >> (np.uint64(64) - shift[over]))
    top = (values >> np.uint64(low_bits)).astype(np.int64)
    n_bits = n + (universe >> low_bits) + 2
    words = -(-n_bits // 64)
    bits = np.zeros(words * 64, np.uint8)
    bits[top + np.arange(n)] = 1
    high = np.packbits(bits, bitorder="little").view("<u8").astype(np.uint64)
    before = np.concatenate([[0], np.cumsum(64 - np.bitwise_count(high).astype(np.int64))])
    return {"head": np.array([n, universe, low_bits], np.int64), "low": low, "high": high, "zeros": before.astype(np.uint32 if before[-1] < 1 << 32 else np.int64)}


class Sequence:
    def __init__(self, arrays: dict[str, np.ndarray]):
        self.n, self.universe, self.low_bits = (int(x) for x in arrays["head"])
        self.low, self.high, self.zeros = arrays["low"], arrays["high"], arrays["zeros"]

    def low_at(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        bit = i.astype(np.uint64) * np.uint64(self.low_bits)
        word, shift = (bit >> np.uint64(6)).astype(np.int64), bit & np.uint64(63)
        # Shifting by 64 is undefined, so the upper part is shifted in two steps.
        out = (self.low[word] >> shift) | (self.low[word + 1] << np.uint64(1) << (np.uint64(63) - shift))
        return out & np.uint64((1 << self.low_bits) - 1)

    def _first_with(self, top: np.ndarray) -> np.ndarray:
        """How many numbers have a high part below ``top``: the place of the zero that ends them, less the zeros before it."""
        k = np.maximum(top - 1, 0)
        word = np.searchsorted(self.zeros, k.astype(self.zeros.dtype), side="right") - 1
        left = (k - self.zeros[word]).astype(np.uint64)
        bits = self.high[word] ^ _ONES
        # How many bits are set up to each byte's end, in that byte; bytes that end too early to hold the wanted one are passed.
        sums = bits - (bits >> np.uint64(1) & np.uint64(0x5555555555555555))
        sums = (sums & np.uint64(0x3333333333333333)) + (sums >> np.uint64(2) & np.uint64(0x3333333333333333))
        sums = (sums + (sums >> np.uint64(4)) & np.uint64(0x0F0F0F0F0F0F0F0F)) * _EACH
        passed = np.bitwise_count((left * _EACH | _TOP) - sums & _TOP).astype(np.uint64) << np.uint64(3)
        left -= sums << np.uint64(8) >> passed & np.uint64(255)
        place = passed + _SELECT[left << np.uint64(8) | bits >> passed & np.uint64(255)]
        return np.where(top > 0, word * 64 + place.astype(np.int64) + 1 - top, 0)

    def _end_of(self, lo: np.ndarray, top: np.ndarray) -> np.ndarray:
        """Where the numbers end that have the high part ``top`` and begin at ``lo``: as many as there are ones before the next zero."""
        at = lo + top
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        rest = (self.high[word] >> shift) | (self.high[np.minimum(word + 1, len(self.high) - 1)] << np.uint64(1) << (np.uint64(63) - shift))
        ones = np.bitwise_count(rest & ~(rest + np.uint64(1)))
        end = lo + ones
        many = np.flatnonzero(ones == 64)
        end[many] = self._first_with(top[many] + 1)
        return end

    def successor(self, targets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each target the place of the first number at or above it (n if none), and whether it is equal."""
        targets = targets.astype(np.uint64)
        inside = targets < np.uint64(self.universe)
        t = np.where(inside, targets, np.uint64(0))
        top = (t >> np.uint64(self.low_bits)).astype(np.int64)
        want = t & np.uint64((1 << self.low_bits) - 1)
        lo = self._first_with(top)
        end = self._end_of(lo, top)
        hi = end.copy()
        while True:  # bisection among the numbers that share the high part, a handful on average
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                break
            mid = (lo[open_] + hi[open_]) >> 1
            less = self.low_at(mid) < want[open_]
            lo[open_] = np.where(less, mid + 1, lo[open_])
            hi[open_] = np.where(less, hi[open_], mid)
        equal = inside & (lo < end)
        at = np.flatnonzero(equal)
        equal[at] = self.low_at(lo[at]) == want[at]
        return np.where(inside, lo, self.n), equal


def find(sequence: Sequence, targets: np.ndarray) -> np.ndarray:
    """Places of the targets that are in the sequence, -1 for the others."""
    place, equal = sequence.successor(targets)
    return np.where(equal, place, -1)
