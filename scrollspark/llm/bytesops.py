"""Vectorised helpers over the UTF-8 buffers of Arrow string columns.

Operators work on slices of a batch: rows whose texts together hold about
``max_bytes``.  A longer text is a slice of its own, so the working memory
follows the longest text, never the batch.
"""

from __future__ import annotations

import ctypes
import functools
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20

#: Word separators: space and the ASCII controls 0x09 to 0x0D.
IS_WORD = np.ones(256, dtype=bool)
IS_WORD[[0x20, *range(0x09, 0x0E)]] = False

#: Bytes of terms: digits, A-Z, a-z and all of characters beyond ASCII.
IS_TERM = np.zeros(256, dtype=bool)
for _first, _end in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
    IS_TERM[_first:_end] = True

#: Lower-cases A-Z and leaves every other byte alone.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_BASE = 0x9E3779B97F4A7C15 | 5  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_CODE = np.random.default_rng(20_240_601).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[int, np.ndarray] = {}


def powers_of(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept between calls."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        steps = np.full(size, base, dtype=np.uint64)
        steps[0] = 1
        have = _powers[base] = np.multiply.accumulate(steps)
    return have[:n]


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column and its row offsets; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        empty = b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else ""
        column = pc.fill_null(column, pa.scalar(empty, column.type))
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offs = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return body[offs[0] : offs[-1]], offs - offs[0]


def slices(offsets: np.ndarray, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose bytes add up to about max_bytes, or single longer rows."""
    n, at = len(offsets) - 1, 0
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + max_bytes, "right")) - 1
        to = min(max(to, at + 1), n)
        yield at, to
        at = to


def word_spans(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray = IS_WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words (runs of bytes of a kind), and for each row the index of its first word (one more at the end)."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    word = kind[data]
    start = word.copy()
    start[1:] &= ~word[:-1]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    start[first] = word[first]
    end = word.copy()
    end[:-1] &= ~word[1:]
    last = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    end[last] = word[last]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def ranges(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges one after the other, and which range each is of."""
    size = ends - starts
    which = np.repeat(np.arange(len(starts)), size)
    return np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size) + starts[which], which


def groups(sorted_keys: np.ndarray) -> tuple[list[int], list[int]]:
    """Where runs of equal keys begin and end."""
    edges = np.append(np.flatnonzero(np.diff(sorted_keys, prepend=-1)), len(sorted_keys)).tolist()
    return edges[:-1], edges[1:]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser: spreads the entropy over all 64 bits."""
    h = h ^ (h >> np.uint64(31))
    h *= np.uint64(0x7FB5D329728EA185)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x81DADEF4BC2DD44D)
    h ^= h >> np.uint64(33)
    return h


def prefix_codes(data: np.ndarray) -> np.ndarray:
    """Sums of coded bytes times powers: differences of two entries identify the bytes between."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_CODE[data] * powers_of(_BASE, len(data)), out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span, the same wherever the bytes stand.  For spans under LONG_SPAN: see byte_hashes."""
    raw = (sums[ends] - sums[starts]) * powers_of(_INVERSE, len(sums))[starts]
    return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


#: Polynomials modulo 2**64 take some strings of 1024 bytes or more (Thue-Morse) for equal, whatever the base, and get weaker on the way there.
LONG_SPAN = 32


def byte_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span of any length: polynomial for short spans, BLAKE2b for long ones."""
    out = span_hashes(prefix_codes(data), starts, ends)
    for i in np.flatnonzero(ends - starts >= LONG_SPAN).tolist():
        out[i] = int.from_bytes(hashlib.blake2b(data[starts[i] : ends[i]], digest_size=8).digest(), "little")
    return out


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = True) -> np.ndarray:
    return byte_hashes(LOWER[data] if fold else data, starts, ends)


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the runs of k words, chained word by word; of the whole sequence if it is shorter and not empty."""
    n = len(words)
    if n == 0:
        return words[:0]
    k = min(k, n)
    out = np.full(n - k + 1, k, np.uint64)
    for j in range(k):
        out *= np.uint64(0xC2B2AE3D27D4EB4F)
        out = mix(out + words[j : n - k + 1 + j])
    return out


class HashTable:
    """A fixed map from distinct 64-bit hashes to 0 .. n-1, looked up for whole arrays."""

    def __init__(self, hashes: np.ndarray):
        self.bits = max(8, int(len(hashes) * 8).bit_length())
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.values = np.full(1 << self.bits, -1, np.int32)
        todo, value, slot = hashes, np.arange(len(hashes), dtype=np.int32), self._slot(hashes)
        while len(todo):
            free = np.flatnonzero(self.values[slot] < 0)
            put = free[np.unique(slot[free], return_index=True)[1]]
            self.keys[slot[put]], self.values[slot[put]] = todo[put], value[put]
            rest = np.ones(len(todo), bool)
            rest[put] = False
            todo, value, slot = todo[rest], value[rest], (slot[rest] + 1) & (len(self.keys) - 1)

    def _slot(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - self.bits)).astype(np.int64)

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        """The value of each hash, -1 if it is not in the table."""
        slot = self._slot(hashes)
        out = self.values[slot]
        miss = np.flatnonzero((out >= 0) & (self.keys[slot] != hashes))
        slot = slot[miss]
        while len(miss):
            slot = (slot + 1) & (len(self.keys) - 1)
            got = self.values[slot]
            out[miss] = got
            on = (got >= 0) & (self.keys[slot] != hashes[miss])
            miss, slot = miss[on], slot[on]
        return out


def tidy() -> None:
    """Gives freed memory back to the system: Python workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library keeps its own house
        pass


def tidied(function: Callable) -> Callable:
    """A function of Arrow batches that tidies up after every batch it has dealt with, and at its end."""

    @functools.wraps(function)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def dealt() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch
                del batch
                tidy()

        yield from function(dealt())
        tidy()

    return run
