"""Vectorised words and rolling hashes over Arrow string buffers.

A word is a run of bytes other than 0x20 and 0x09-0x0D. Hashes are polynomials modulo 2**64 over random byte codes, taken
from prefix sums, then mixed; a word's hash depends on its bytes alone, so every executor and every run agrees.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_rng = np.random.Generator(np.random.PCG64(20240229))
_CODES = _rng.integers(1, 2**64 - 1, 256, dtype=U)
_LOWER = _CODES.copy()
_LOWER[ord("A") : ord("Z") + 1] = _CODES[ord("a") : ord("z") + 1]
_BASE = [U(0x9E3779B97F4A7C15 | 1), U(0xD6E8FEB86659FD93 | 1)]
CHUNK_BYTES = 1 << 20


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection of 64-bit integers whose output bits depend on all input bits (the finaliser of splitmix64)."""
    x = x ^ U(salt) if salt else x.copy()
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


class Powers:
    """Powers of a base and of its inverse modulo 2**64, as long as they have been needed so far."""

    def __init__(self, base: np.uint64):
        self.base, self.inverse = int(base), pow(int(base), -1, 1 << 64)
        self.up = self.down = np.ones(1, U)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            k = len(self.up)
            self.up = np.concatenate([self.up, self.up * U(pow(self.base, k, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * U(pow(self.inverse, k, 1 << 64))])
        return self.up, self.down


_POWERS = [Powers(b) for b in _BASE]


def rolling(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray | int, which: int = 0) -> np.ndarray:
    """Hashes of values[start : start + length] for many starts, through prefix sums of a polynomial."""
    up, down = _POWERS[which].upto(len(values) + 1)
    sums = np.empty(len(values) + 1, U)
    sums[0] = 0
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return mix((sums[starts + lengths] - sums[starts]) * down[starts])


@dataclass
class Words:
    """Words of some documents. first has len(documents) + 1 entries: document d owns words first[d] to first[d + 1]."""

    hashes: np.ndarray
    first: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    data: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def words(data: np.ndarray, offsets: np.ndarray, lower: bool) -> Words:
    """data: UTF-8 of all documents, one behind the other; offsets: where each begins, and the end."""
    n = len(data)
    space = SPACE[data]
    before = np.ones(n + 1, bool)
    before[1:] = space
    after = np.ones(n + 1, bool)
    after[:n] = space
    before[offsets] = True
    after[offsets] = True
    starts = np.flatnonzero(~space & before[:n])
    ends = np.flatnonzero(~space & after[1:]) + 1
    hashes = rolling((_LOWER if lower else _CODES)[data], starts, ends - starts)
    return Words(hashes, np.searchsorted(starts, offsets), starts, ends, data)


def chunks(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string column into row ranges of about ``size`` bytes: (first row, end row, bytes, offsets). Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def owners(first: np.ndarray) -> np.ndarray:
    """The document of each element."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def distinct_shingles(w: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of ``width``-word shingles of each document, and where each document's begin. A document with
    fewer words has the whole sequence as its one shingle; one without words has none."""
    n = w.counts
    count = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    first = np.concatenate([[0], np.cumsum(count)])
    doc = owners(first)
    starts = w.first[doc] + np.arange(first[-1]) - first[doc]
    hashes = rolling(w.hashes, starts, np.minimum(width, n)[doc])
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        hashes[a:b].sort()
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    return hashes[new], np.concatenate([[0], np.cumsum(np.bincount(doc[new], minlength=len(n)))]).astype(np.int64)
