"""Vectorised word scanning of Arrow text columns (numpy, inside Spark tasks).

Words are maximal runs of bytes outside ``\\x20 \\x09-\\x0D`` of the UTF-8 text with A-Z
lower-cased; a word's 64-bit hash is a polynomial over randomised byte values, taken for all
words of a chunk at once from one running sum. Rows are handled in chunks of bounded bytes, so a
task's memory does not depend on its partition's size (only on its longest single text).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 2 << 20

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
# The same with ASCII punctuation between words.
PUNCTUATION = SPACE.copy()
PUNCTUATION[[c for c in range(0x21, 0x7F) if not chr(c).isalnum()]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_VALUES = np.random.Generator(np.random.PCG64(7)).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 2**64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base ** i mod 2**64`` for i < n (grown as needed, shared within a worker)."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, CHUNK_BYTES), base, dtype=np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        _powers[base] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a string column; null rows are empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if not pa.types.is_large_string(column.type) and not pa.types.is_string(column.type):
        column, width = column.cast(pa.large_string()), np.int64
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offs = np.frombuffer(offsets, width)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of about ``limit`` bytes (a longer single row is its own range)."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(n, max(lo + 1, hi))
        yield lo, hi
        lo = hi


class Words:
    """The words of a chunk of rows: ``start``/``end`` byte positions, ``row`` and ``hash``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, between: np.ndarray = SPACE):
        base = int(offsets[0])
        self.rows = len(offsets) - 1
        self.offsets = offsets - base
        self.data = LOWER[data[base:int(offsets[-1])]]
        n = len(self.data)
        if n == 0:
            self.start = self.end = self.row = np.zeros(0, np.int64)
            self.hash = np.zeros(0, np.uint64)
            self.first = np.zeros(self.rows + 1, np.int64)
            return
        inside = ~between[self.data]
        cut = np.zeros(n + 1, dtype=bool)
        cut[self.offsets] = True
        before = np.empty(n, dtype=bool)
        before[0] = False
        before[1:] = inside[:-1]
        self.start = np.flatnonzero(inside & (~before | cut[:n]))
        after = np.empty(n, dtype=bool)
        after[-1] = False
        after[:-1] = inside[1:]
        self.end = np.flatnonzero(inside & (~after | cut[1:])) + 1
        sums = np.empty(n + 1, dtype=np.uint64)
        sums[0] = 0
        np.cumsum(_VALUES[self.data] * powers(_BASE, n), out=sums[1:])
        self.hash = mix((sums[self.end] - sums[self.start]) * powers(_BASE_INVERSE, n)[self.start])
        self.first = np.searchsorted(self.start, self.offsets)
        self.row = np.repeat(np.arange(self.rows), np.diff(self.first))

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash, row) of every run of ``size`` words within a row, at its first word."""
        n = len(self.hash) - size + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        total = np.zeros(n, np.uint64)
        for j in range(size):
            total += self.hash[j:j + n] * np.uint64(2 * (j * 0x5851F42D4C957F2D % 2**62) + 1)
        whole = self.row[:n] == self.row[size - 1:]
        return mix(total[whole]), self.row[:n][whole]

    def shingle_sets(self, size: int) -> Iterator[np.ndarray]:
        """Per row: its sorted distinct shingle hashes; a shorter row's whole word sequence counts
        as one shingle, a row without words has none."""
        hashes, rows = self.shingles(size)
        bounds = np.searchsorted(rows, np.arange(self.rows + 1))
        counts = np.diff(self.first)
        for r in range(self.rows):
            if counts[r] >= size:
                yield np.unique(hashes[bounds[r]:bounds[r + 1]])
            elif counts[r]:
                words = self.hash[self.first[r]:self.first[r + 1]]
                yield mix((words * powers(_BASE, 64)[1:len(words) + 1]).sum(keepdims=True) + np.uint64(len(words)))
            else:
                yield np.zeros(0, np.uint64)
