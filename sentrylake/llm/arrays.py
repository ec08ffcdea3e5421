"""Vectorised text work for Arrow batches: byte views, words, word and n-gram hashes."""

from __future__ import annotations

import ctypes
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: White space that separates words: space and 0x09 to 0x0D.
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
#: A-Z to a-z, other bytes unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_POLY = U64(0x9E3779B97F4A7C15)
_POWERS = np.multiply.accumulate(np.concatenate([np.ones(1, U64), np.full(255, _POLY, U64)]))

#: Bytes of text handled at once; a longer single text is handled alone.
SLICE_BYTES = 1 << 19


def powers(n: int) -> np.ndarray:
    global _POWERS
    if n > len(_POWERS):
        _POWERS = np.multiply.accumulate(np.concatenate([np.ones(1, U64), np.full(n + n // 2, _POLY, U64)]))
    return _POWERS


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def byte_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column without copying the text; nulls are empty."""
    if pa.types.is_string(column.type):
        column = column.view(pa.binary())
    elif pa.types.is_large_string(column.type):
        column = column.view(pa.large_binary())
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    n = len(column)
    if data is None or n == 0:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    ends = np.frombuffer(offsets, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8), ends


def release() -> None:
    """Hands memory that a worker holds but does not use back to the system: workers live on from stage to stage."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library keeps its own counsel
        pass


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0): row ranges of about ``most`` bytes."""
    data, ends = byte_view(column)
    n, lo = len(ends) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + most, "right")) - 1)
        yield lo, hi, data[ends[lo] : ends[hi]], ends[lo : hi + 1] - ends[lo]
        lo = hi
    release()


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first word of each row and the total): words are runs without white space."""
    solid = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    start = solid.copy()
    start[1:] &= ~solid[:-1] | edge[1:-1]
    stop = solid.copy()
    stop[:-1] &= ~solid[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(stop) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    if not len(starts):
        return np.zeros(0, U64)
    lengths = ends - starts
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    values = data[place + np.repeat(starts, lengths)].astype(U64)
    values += U64(1)
    values *= powers(int(lengths.max()))[place]
    return mix(np.add.reduceat(values, first) + lengths.astype(U64) * U64(0xD6E8FEB86659FD93))


def gram_hashes(hashes: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """The hash of hashes[i:i+n] for each i; those past the end are left out."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, U64)
    out = np.full(m, U64((seed * 0x2545F4914F6CDD1D) & 0xFFFFFFFFFFFFFFFF), U64)
    for k in range(n):
        out *= U64(0x9FB21C651E98DF25)
        out += hashes[k : k + m]
    return mix(out)


#: A word of one text, for code that walks single texts.
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def utf8(value) -> bytes:
    return b"" if value is None else value if isinstance(value, bytes) else value.encode("utf-8", "surrogatepass")
