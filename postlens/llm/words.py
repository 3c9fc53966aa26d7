"""Words of whole columns of text as numpy arrays, for use inside Arrow tasks.

A word is a longest run of ``[0-9a-z]`` and bytes from 0x80 on, after A-Z are lower-cased. That is the
pattern ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` on characters, since UTF-8 writes every other
character with bytes from 0x80 on. All rows of a piece are split and hashed at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import types as T

#: Bytes of text that are turned into arrays at once; it bounds the memory of a task. A longer single text is a piece by itself.
PIECE_BYTES = 2 << 20


def _bytes_kept(*ranges: tuple[int, int]) -> np.ndarray:
    """For each byte its lower-case form, or 0 where it separates words."""
    table = np.zeros(256, np.uint8)
    for first, last in ranges:
        table[first : last + 1] = np.arange(first, last + 1)
    table[0x41:0x5B] = np.arange(0x61, 0x7B)
    return table


WORD_BYTES = _bytes_kept((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
LETTER_BYTES = _bytes_kept((0x61, 0x7A), (0x80, 0xFF))

_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 1 << 64)
_CODES = np.random.default_rng(1).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_CODES[0] = 0
_powers = np.ones((2, 1), np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers; a bijection."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int) -> np.ndarray:
    """The first ``n`` powers of a factor and of its inverse modulo 2**64, kept between calls."""
    global _powers
    if _powers.shape[1] < n:
        base = np.full((2, max(n, PIECE_BYTES + 1)), [[_FACTOR], [_INVERSE]], np.uint64)
        base[:, 0] = 1
        _powers = np.cumprod(base, axis=1, dtype=np.uint64)
    return _powers[:, :n]


def extended(schema: T.StructType, more: str) -> T.StructType:
    """A schema with the fields of a DDL string behind its own."""
    return T.StructType([*schema.fields, *T.StructType.fromDDL(more).fields])


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row and where each begins, with the end; a null is an empty text."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of at most ``size`` bytes of text, or of one row."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, before + size, "right")))
            yield batch.slice(at, stop - at)
            at = stop


class Words:
    """``begin`` and ``end`` of each word in ``data``, ``doc`` it is in, 64-bit ``hash``; ``first`` word of each doc, with the end."""

    def __init__(self, column: pa.Array, table: np.ndarray = WORD_BYTES):
        data, offsets = text_bytes(column)
        self.data, self.offsets = table[data], offsets
        n = len(data)
        inside = np.zeros(n + 2, bool)
        inside[1:-1] = self.data != 0
        start, stop = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
        filled = offsets[:-1] < offsets[1:]
        a, z = offsets[:-1][filled], offsets[1:][filled] - 1
        start[a], stop[z] = inside[a + 1], inside[z + 1]
        self.begin, self.end = np.flatnonzero(start), np.flatnonzero(stop) + 1
        self.first = np.searchsorted(self.begin, offsets)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(offsets) - 1), self.count)

    @property
    def hash(self) -> np.ndarray:
        up, down = powers(len(self.data) + 1)
        total = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(_CODES[self.data] * up[:-1], out=total[1:])
        return mix((total[self.end] - total[self.begin]) * down[self.begin])


def runs(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words from each place on; the last ``n - 1`` places have none. Runs may cross documents."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    up = powers(n + 1)[0]
    total = words[: len(words) - n + 1] * up[1]
    for i in range(1, n):
        total += words[i : len(words) - n + 1 + i] * up[i + 1]
    return mix(total)
