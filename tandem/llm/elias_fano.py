"""Monotone sequences in Elias-Fano form, as flat buffers that can be mapped.

Of each value the low bits stand packed side by side and the high bits in unary: a one for
each value after as many zeros as its high part. Buffers of a file on disk can be mapped and
read in place; nothing is unpacked but the high bits of a sequence in use.
"""

from __future__ import annotations

import struct
from functools import cached_property

import numpy as np

_HEAD = struct.Struct("<QQB7x")


class EliasFano:
    def __init__(self, n: int, low_bits: int, lows: np.ndarray, highs: np.ndarray):
        self.n, self.low_bits, self.lows, self.highs = n, low_bits, lows, highs

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        """``values``: unsigned, never falling, below 2 ** 62."""
        values = values.astype(np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // max(n, 1)).bit_length() - 1)
        high = (values >> np.uint64(low_bits)).astype(np.int64)
        bits = np.zeros(n + (int(high[-1]) if n else 0) + 1, dtype=np.uint8)
        bits[high + np.arange(n)] = 1
        words = np.zeros(n * low_bits // 64 + 2, dtype=np.uint64)
        if low_bits:
            at = np.arange(n, dtype=np.uint64) * np.uint64(low_bits)
            word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            low = values & np.uint64((1 << low_bits) - 1)
            np.bitwise_or.at(words, word, low << shift)
            over = shift + np.uint64(low_bits) > 64
            np.bitwise_or.at(words, word[over] + 1, low[over] >> (np.uint64(64) - shift[over]))
        return cls(n, low_bits, words, np.packbits(bits, bitorder="little"))

    def to_bytes(self) -> bytes:
        head = _HEAD.pack(self.n, len(self.highs), self.low_bits)
        pad = b"\0" * (-len(self.highs) % 8)
        return head + self.lows.tobytes() + self.highs.tobytes() + pad

    @classmethod
    def from_buffer(cls, buffer, offset: int = 0) -> tuple[EliasFano, int]:
        """The sequence at ``offset`` of a buffer, read in place, and the offset after it."""
        n, n_highs, low_bits = _HEAD.unpack_from(buffer, offset)
        at = offset + _HEAD.size
        n_lows = n * low_bits // 64 + 2
        lows = np.frombuffer(buffer, np.uint64, n_lows, at)
        at += 8 * n_lows
        highs = np.frombuffer(buffer, np.uint8, n_highs, at)
        return cls(n, low_bits, lows, highs), at + n_highs + (-n_highs % 8)

    @cached_property
    def _bits(self) -> np.ndarray:
        return np.unpackbits(self.highs, bitorder="little")

    @cached_property
    def _ones(self) -> np.ndarray:
        return np.flatnonzero(self._bits)

    @cached_property
    def _before(self) -> np.ndarray:
        """How many values have a high part below h, for each h."""
        zeros = np.flatnonzero(self._bits == 0)
        return np.concatenate([[0], np.minimum(zeros - np.arange(len(zeros)), self.n)])

    def _low(self, at: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(at), dtype=np.uint64)
        bit = at.astype(np.uint64) * np.uint64(self.low_bits)
        word, shift = (bit >> np.uint64(6)).astype(np.int64), bit & np.uint64(63)
        value = self.lows[word] >> shift
        more = shift > 0
        value[more] |= self.lows[word[more] + 1] << (np.uint64(64) - shift[more])
        return value & np.uint64((1 << self.low_bits) - 1)

    def get(self, at: np.ndarray) -> np.ndarray:
        """The values at the places ``at``."""
        high = (self._ones[at] - at).astype(np.uint64)
        return (high << np.uint64(self.low_bits)) | self._low(at)

    def successor(self, values: np.ndarray) -> np.ndarray:
        """For each of ``values`` the first place whose value is not below it, or n.

        The high part leads to the values that share it; the low part is searched in them.
        """
        values = values.astype(np.uint64)
        high = (values >> np.uint64(self.low_bits)).astype(np.int64)
        top = len(self._before) - 2
        beyond = high > top
        high = np.minimum(high, max(top, 0))
        at, end = self._before[high].copy(), self._before[high + 1].copy()
        low = values & np.uint64((1 << self.low_bits) - 1)
        at[beyond] = end[beyond] = self.n
        live = np.flatnonzero(at < end)
        while len(live):
            middle = (at[live] + end[live]) >> 1
            less = self._low(middle) < low[live]
            at[live[less]] = middle[less] + 1
            end[live[~less]] = middle[~less]
            live = live[at[live] < end[live]]
        return at
