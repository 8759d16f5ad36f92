"""Elias-Fano coded sorted numbers in numpy, searched without unpacking them."""

from __future__ import annotations

import numpy as np

BLOCK_WORDS = 8
BLOCK_BITS = 64 * BLOCK_WORDS
# For each byte, the place of its k-th zero bit.
_ZERO_IN_BYTE = np.full((256, 8), 8, np.uint8)
for _byte in range(256):
    _places = [b for b in range(8) if not _byte >> b & 1]
    _ZERO_IN_BYTE[_byte, :len(_places)] = _places
_U = np.uint64


class EliasFano:
    """Non-decreasing numbers from 0 on: the lower bits packed, the upper bits in unary.

    `upper` holds for each number a one at (its upper bits + its index); a directory of the
    zeros before each block gives select by one binary search and a few bit counts.
    """

    def __init__(self, n: int, low_bits: int, lower: np.ndarray, upper: np.ndarray,
                 zeros: np.ndarray):
        self.n, self.low_bits = n, low_bits
        self.lower, self.upper, self.zeros = lower, upper, zeros

    @classmethod
    def build(cls, values: np.ndarray, universe: int) -> EliasFano:
        values = np.asarray(values, np.int64)
        n = len(values)
        low_bits = max(0, int(universe // max(1, n)).bit_length() - 1)
        low = (values & ((1 << low_bits) - 1)).astype(_U)
        place = np.arange(n, dtype=np.int64) * low_bits
        lower = np.zeros(n * low_bits // 64 + 2, _U)
        if low_bits:
            shift = (place & 63).astype(_U)
            np.bitwise_or.at(lower, place >> 6, low << shift)
            over = np.flatnonzero((place & 63) + low_bits > 64)
            np.bitwise_or.at(lower, (place[over] >> 6) + 1, low[over] >> (_U(64) - shift[over]))
        ones = (values >> low_bits) + np.arange(n)
        size = n + (universe >> low_bits) + 2
        words = -(-size // BLOCK_BITS) * BLOCK_WORDS
        upper = np.zeros(words, _U)
        np.bitwise_or.at(upper, ones >> 6, _U(1) << (ones & 63).astype(_U))
        per_block = np.bitwise_count(~upper).reshape(-1, BLOCK_WORDS).sum(axis=1, dtype=np.int64)
        zeros = np.concatenate([[0], np.cumsum(per_block)[:-1]]).astype(np.int64)
        return cls(n, low_bits, lower, upper, zeros)

    def arrays(self) -> list[np.ndarray]:
        return [np.array([self.n, self.low_bits], np.int64), self.lower, self.upper, self.zeros]

    @classmethod
    def of(cls, arrays: list[np.ndarray]) -> EliasFano:
        head, lower, upper, zeros = arrays
        return cls(int(head[0]), int(head[1]), lower, upper, zeros)

    def _select0(self, k: np.ndarray) -> np.ndarray:
        """The place of the k-th zero of `upper`, from 0."""
        block = np.searchsorted(self.zeros, k, "right") - 1
        left = k - self.zeros[block]
        words = self.upper[block[:, None] * BLOCK_WORDS + np.arange(BLOCK_WORDS)]
        counts = np.cumsum(np.bitwise_count(~words), axis=1, dtype=np.int64)
        word = (counts <= left[:, None]).sum(axis=1)
        rows = np.arange(len(k))
        left = left - np.where(word > 0, counts[rows, np.maximum(word - 1, 0)], 0)
        octets = words[rows, word].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts = np.cumsum(np.bitwise_count(~octets), axis=1, dtype=np.int64)
        octet = (counts <= left[:, None]).sum(axis=1)
        left = left - np.where(octet > 0, counts[rows, np.maximum(octet - 1, 0)], 0)
        bit = _ZERO_IN_BYTE[octets[rows, octet], left]
        return block * BLOCK_BITS + word * 64 + octet * 8 + bit

    def _low(self, at: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(at), _U)
        place = at * self.low_bits
        shift = (place & 63).astype(_U)
        value = self.lower[place >> 6] >> shift
        # A shift by 64 bits would be undefined, so it is done in two steps.
        value |= (self.lower[(place >> 6) + 1] << _U(1)) << (_U(63) - shift)
        return value & _U((1 << self.low_bits) - 1)

    def get(self, at: np.ndarray) -> np.ndarray:
        """The numbers at some places, by searching the directory for their ones."""
        ones = np.arange(len(self.zeros), dtype=np.int64) * BLOCK_BITS - self.zeros
        block = np.searchsorted(ones, at, "right") - 1
        left = at - ones[block]
        words = self.upper[block[:, None] * BLOCK_WORDS + np.arange(BLOCK_WORDS)]
        bits = np.unpackbits(words.astype("<u8").view(np.uint8).reshape(len(at), -1), axis=1,
                             bitorder="little")
        place = (np.cumsum(bits, axis=1, dtype=np.int32) <= left[:, None]).sum(axis=1)
        high = block * BLOCK_BITS + place - at
        return (high << self.low_bits) | self._low(at).astype(np.int64)

    def successor(self, x: np.ndarray, start: np.ndarray | None = None,
                  stop: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """For each x the place of the first number >= x, and whether it is x itself.

        With `start` and `stop` the search is confined to these places. Numbers that share
        the upper bits of x lie between two zeros of `upper`; only these are compared. x may
        not exceed the universe.
        """
        if not len(x) or not self.n:
            return np.zeros(len(x), np.int64), np.zeros(len(x), bool)
        x = np.asarray(x, np.int64)
        high = x >> self.low_bits
        low = (x & ((1 << self.low_bits) - 1)).astype(_U)
        end = self._select0(high) - high
        first = np.where(high > 0, self._select0(np.maximum(high - 1, 0)) - np.maximum(high - 1, 0), 0)
        if start is not None:
            first, end = np.maximum(first, start), np.minimum(end, stop)
        lo, hi = first.copy(), np.maximum(first, end)
        while True:
            active = np.flatnonzero(lo < hi)
            if not len(active):
                break
            middle = (lo[active] + hi[active]) >> 1
            less = self._low(middle) < low[active]
            lo[active[less]] = middle[less] + 1
            hi[active[~less]] = middle[~less]
        found = lo < end
        at = np.flatnonzero(found)
        found[at] = self._low(lo[at]) == low[at]
        return lo, found


def pack(arrays: list[np.ndarray]) -> bytes:
    """Arrays one after the other, 8-byte aligned, behind a table of their kinds and sizes."""
    head = [f"{a.dtype.str}:{a.size}" for a in arrays]
    first = ";".join(head).encode()
    parts = [np.int64(len(first)).tobytes(), first, bytes(-len(first) % 8)]
    for a in arrays:
        data = np.ascontiguousarray(a).tobytes()
        parts += [data, bytes(-len(data) % 8)]
    return b"".join(parts)


def unpack(data: np.ndarray) -> list[np.ndarray]:
    """The arrays of `pack` as views of (memory-mapped) bytes."""
    size = int(data[:8].view(np.int64)[0])
    at = 8 + size + -size % 8
    out = []
    for entry in bytes(data[8:8 + size]).decode().split(";"):
        kind, n = entry.split(":")
        n_bytes = np.dtype(kind).itemsize * int(n)
        out.append(data[at:at + n_bytes].view(kind))
        at += n_bytes + -n_bytes % 8
    return out
