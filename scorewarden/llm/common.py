"""Shared pieces: document keys, shared storage, and vectorised word hashing for Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewarden.storage import settled

__all__ = ["SPACE", "Words", "chunks", "mixed_bits", "prefix_sums", "ranges", "settled", "span_hashes", "text_key", "word_table"]

#: Space and the control characters 9 to 13, as trim characters.
SPACE = " \t\n\x0b\x0c\r"

# An odd multiplier has an inverse modulo 2**64, which turns prefix sums into hashes of any range.
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def text_key(text: Column, first: str = "_k1", second: str = "_k2") -> list[Column]:
    """A 128-bit key of a text as two longs; equal texts share it wherever they are computed."""
    return [F.xxhash64(text).alias(first), F.xxhash64(F.lit("second"), text).alias(second)]


def chunks(offsets: np.ndarray, limit: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of about ``limit`` bytes, so that arrays of numbers per byte stay small; a longer text is a range of its own."""
    start, n = 0, len(offsets) - 1
    while start < n:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        stop = min(n, max(stop, start + 1))
        yield start, stop
        start = stop


def ranges(array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow string array without nulls; no copy of the texts."""
    import pyarrow as pa
    import pyarrow.compute as pc
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    array = pc.fill_null(array.cast(pa.large_string()), "")
    _, offsets, data = array.buffers()
    at = np.frombuffer(offsets, np.int64)[array.offset: array.offset + len(array) + 1] if offsets else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), at


def mixed_bits(h: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit value over all others."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = 1 << max(18, n.bit_length())
        for i, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Running sums from which ``span_hashes`` reads the hash of any byte range."""
    up, _ = _powers_to(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, down = _powers_to(len(sums))
    lengths = (ends - starts).astype(np.uint64)
    return mixed_bits((sums[ends] - sums[starts]) * down[starts] + lengths * np.uint64(0xC2B2AE3D27D4EB4F))


def word_table(kinds: bool = False) -> np.ndarray:
    """Class of each byte: 0 space, 1 word; with ``kinds`` also 2 for ASCII punctuation."""
    table = np.ones(256, np.uint8)
    table[[32, 9, 10, 11, 12, 13]] = 0
    if kinds:
        marks = [b for b in range(33, 127) if not chr(b).isalnum()]
        table[marks] = 2
    return table


class Words:
    """Words of the texts of one chunk: ``hashes``, the row ``doc`` of each, and the number of ``docs``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, table: np.ndarray, *, fold: bool = False):
        base, end = int(offsets[0]), int(offsets[-1])
        part = data[base:end]
        edges = offsets - base
        self.docs = len(offsets) - 1
        kind = table[part]
        new = np.ones(len(part) + 1, bool)
        if len(part):
            new[1:-1] = kind[1:] != kind[:-1]
        new[edges] = True
        cuts = np.flatnonzero(new)
        starts, ends = cuts[:-1], cuts[1:]
        keep = kind[starts] > 0 if len(starts) else np.zeros(0, bool)
        starts, ends = starts[keep], ends[keep]
        if fold:
            upper = (part >= 65) & (part <= 90)
            part = part + upper.astype(np.uint8) * np.uint8(32)
        self.starts, self.ends = starts, ends
        self.hashes = span_hashes(prefix_sums(part), starts, ends)
        self.doc = np.searchsorted(edges, starts, "right") - 1
        self.kind = kind[starts] if len(starts) else np.zeros(0, np.uint8)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of every run of ``n`` words inside a text, and the row of each."""
        m = len(self.hashes) - n + 1
        if m <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        value = np.zeros(m, np.uint64)
        for i in range(n):
            value = value * _BASE + self.hashes[i: i + m]
        inside = self.doc[:m] == self.doc[n - 1:]
        return mixed_bits(value)[inside], self.doc[:m][inside]
