"""Words of many texts at once, by byte tables and prefix sums over UTF-8.

Both word patterns used here are plain byte classes: every byte of a multi-byte
character is a word byte in either. A text that is null has no words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Bytes of text worked on at once: the arrays made of them take about 40 times that.
SLICE_BYTES = 2 << 20

_BYTES = np.arange(256)
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
# [^\x20\x09-\x0D]+
NOT_SPACE = ~((_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13)))
# [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of lower-cased text
ALPHANUMERIC = (
    ((_BYTES >= 48) & (_BYTES <= 57)) | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)
)

_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODD_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))
_STEP = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_VALUE = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _ODD)


@dataclass
class Words:
    """``data``: lower-cased words, each followed by one space; word i is
    ``data[starts[i]:ends[i]]``; text t has the words ``bounds[t]:bounds[t + 1]``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        n = len(self.data)
        power = np.full(n, _ODD, dtype=np.uint64)
        back = np.full(n, _ODD_INVERSE, dtype=np.uint64)
        if n:
            power[0] = back[0] = 1
        np.multiply.accumulate(power, out=power)
        np.multiply.accumulate(back, out=back)
        sums = np.zeros(n + 1, dtype=np.uint64)
        power *= _BYTE_VALUE[self.data]
        np.cumsum(power, out=sums[1:])
        value = (sums[self.ends] - sums[self.starts]) * back[self.starts]
        return mix(value + (self.ends - self.starts).astype(np.uint64))

    def join(self, start: int, end: int) -> str:
        """The words ``start:end`` with one space between them."""
        return self.data[self.starts[start] : self.ends[end - 1]].tobytes().decode(
            "utf-8", "replace"
        )


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` words, the last ``size - 1`` places left out."""
    n = max(0, len(hashes) - size + 1)
    value = np.zeros(n, dtype=np.uint64)
    for i in range(size):
        value = value * _STEP + hashes[i : i + n]
    return mix(value + np.uint64(size))


def inside(bounds: np.ndarray, size: int, n: int) -> np.ndarray:
    """For each of the first ``n`` places: does a run of ``size`` words stay in its text?"""
    ok = np.ones(n, dtype=bool)
    for i in range(1, size):
        at = bounds[1:-1] - i
        ok[at[(at >= 0) & (at < n)]] = False
    return ok


def split_words(texts: pa.Array, word_bytes: np.ndarray, lower: bool = True) -> Words:
    raw, offsets = text_bytes(texts)
    table = LOWER if lower else np.arange(256, dtype=np.uint8)
    data = np.empty(len(raw) + len(texts), dtype=np.uint8)
    at = np.arange(len(texts)) + offsets[1:]
    gap = np.zeros(len(data), dtype=bool)
    gap[at] = True
    data[~gap] = table[raw]
    data[gap] = 32
    is_word = word_bytes[data] & ~gap
    before = np.zeros(len(data), dtype=bool)
    before[1:] = is_word[:-1]
    keep = is_word | before
    last = before & ~is_word
    n_words = np.cumsum(last)
    bounds = np.concatenate([[0], n_words[at]]).astype(np.int64)
    data[last] = 32
    data, ends = data[keep], np.flatnonzero(last[keep])
    starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    return Words(data, starts.astype(np.int64), ends.astype(np.int64), bounds)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, and n + 1 offsets into them; a null is empty."""
    texts = texts.fill_null("") if texts.null_count else texts
    wide = pa.types.is_large_string(texts.type)
    _, places, values = texts.buffers()
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(places, dtype=kind, count=len(texts) + 1 + texts.offset)[
        texts.offset :
    ].astype(np.int64)
    if values is None:
        return np.zeros(0, dtype=np.uint8), offsets - offsets[0]
    raw = np.frombuffer(values, dtype=np.uint8)[offsets[0] : offsets[-1]]
    return raw, offsets - offsets[0]


def slices(
    batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in pieces of about ``limit`` bytes of text, in order.

    A longer text comes by itself, whole.
    """
    for batch in batches:
        column = batch.column(text)
        _, offsets = text_bytes(column)
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
            end = min(max(end, at + 1), batch.num_rows)
            yield batch.slice(at, end - at)
            at = end
