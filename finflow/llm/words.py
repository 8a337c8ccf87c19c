"""Words of many texts at once: numpy over the bytes of an Arrow string column.

A word is a longest run of word bytes inside one text. UTF-8 keeps every byte of
a non-ASCII character at 0x80 or above, so a table of 256 bytes says exactly
what a class of ASCII characters says.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Byte classes of the two word definitions.
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[list(SPACES)] = False
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[0x30:0x3A] = ALPHANUMERIC[0x61:0x7B] = ALPHANUMERIC[0x80:] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_PIECE = 1 << 20
_powers = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values one to one."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def text_column(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of a string column; null counts as empty."""
    column = batch.column(batch.schema.get_field_index(name))
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    kind = np.int64 if wide else np.int32
    _, offsets, data = column.buffers()
    if offsets is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def runs(offsets: np.ndarray, size: int = _PIECE) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes; a longer text is a range of its own."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


@dataclass
class Words:
    """Words of consecutive texts: byte bounds, and where each text's words begin."""

    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    def owners(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts)


def find_words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> Words:
    inside = table[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    before = np.concatenate(([False], inside[:-1])) if len(data) else inside
    after = np.concatenate((inside[1:], [False])) if len(data) else inside
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return Words(starts, ends, np.searchsorted(starts, offsets))


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers["up"]) < n:
        size = max(n, _PIECE)
        for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[name] = np.multiply.accumulate(table)
    return _powers["up"], _powers["down"]


def hash_words(data: np.ndarray, words: Words, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each word: a polynomial over its bytes by prefix sums, then scattered.

    Works in pieces that end with a word, so memory follows the longest word and
    not the longest text.
    """
    out = np.empty(len(words.starts), np.uint64)
    first, count = 0, len(words.starts)
    while first < count:
        origin = words.starts[first]
        last = max(first + 1, int(np.searchsorted(words.ends, origin + _PIECE, "right")))
        begin, end = words.starts[first:last] - origin, words.ends[first:last] - origin
        up, down = _power_table(int(end[-1]) + 1)
        sums = np.zeros(int(end[-1]) + 1, np.uint64)
        np.cumsum((data[origin : origin + end[-1]].astype(np.uint64) + np.uint64(1)) * up[: end[-1]], out=sums[1:])
        h = (sums[end] - sums[begin]) * down[begin]
        out[first:last] = mix(h + np.uint64(seed) + (end - begin).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        first = last
    return out


def join_hashes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of two neighbouring windows read as one."""
    return mix(left * np.uint64(0xA0761D6478BD642F) + (right ^ np.uint64(0xE7037ED1A0B428DB)))


def window_hashes(h: np.ndarray, length: int) -> np.ndarray:
    """Hash of each window of ``length`` consecutive values, by doubling; the last step may overlap."""
    if len(h) < length:
        return np.zeros(0, np.uint64)
    size = 1
    while size * 2 <= length:
        h = join_hashes(h[:-size], h[size:])
        size *= 2
    if size < length:
        step = length - size
        h = join_hashes(h[:-step], h[step:])
    return h


def window_starts(words: Words, length: int) -> np.ndarray:
    """Mask over words: does a window of ``length`` words of one text begin here?"""
    count = len(words.starts)
    mask = np.zeros(count, bool)
    if count:
        last = np.repeat(words.offsets[1:], words.counts)
        mask = np.arange(count) + length <= last
    return mask


def binary_column(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Rows ``values[bounds[i]:bounds[i+1]]`` as a binary column, without a copy per row."""
    width = values.dtype.itemsize
    offsets = np.ascontiguousarray(bounds, dtype=np.int64) * width
    column = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))]
    )
    return column.cast(pa.binary())
