"""Vectorised text helpers that run inside tasks on the bytes of an Arrow column.

A column's UTF-8 buffer is cut into slices of whole documents of about
``SLICE_BYTES`` (one longer document is a slice of its own), so the working
arrays stay a fixed multiple of that whatever the Arrow batch holds.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
# everything ASCII but letters and digits
PUNCTUATION = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser (in place on a fresh array)."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(32)
    return h


@functools.lru_cache(maxsize=2)
def _byte_values(lower: bool) -> np.ndarray:
    """A 64-bit value per byte; with ``lower`` A-Z get the values of a-z."""
    codes = np.arange(256, dtype=np.uint64)
    if lower:
        codes[65:91] += np.uint64(32)
    return mix((codes + np.uint64(1)) * np.uint64(_BASE))


@functools.lru_cache(maxsize=2)
def _powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, _INVERSE):
        p = np.full(length, base, dtype=np.uint64)
        p[0] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    return out[0], out[1]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least n + 1 of them."""
    return _powers(max(SLICE_BYTES * 2, 1 << int(n + 1).bit_length()))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw, off


def slices(off: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole documents holding at most ``limit`` bytes (or one document)."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, side="right")) - 1)
        yield i, j
        i = j


def word_bounds(buf: np.ndarray, off: np.ndarray, breaks: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes outside ``breaks`` (by default the
    words ``[^\\x20\\x09-\\x0D]+``); none crosses a document."""
    n = len(buf)
    if not n:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    solid = ~breaks[buf]
    edge = np.zeros(n + 1, dtype=bool)
    edge[off] = True
    before = np.empty(n, dtype=bool)
    before[0], before[1:] = True, ~solid[:-1]
    after = np.empty(n, dtype=bool)
    after[-1], after[:-1] = True, ~solid[1:]
    starts = np.flatnonzero(solid & (before | edge[:-1]))
    ends = np.flatnonzero(solid & (after | edge[1:])) + 1
    return starts, ends


def prefix_sums(buf: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Sums ``t`` and inverse powers ``v``: bytes a..b-1 hash to
    ``mix((t[b] - t[a]) * v[a])``, wherever they stand."""
    pw, inv = powers(len(buf))
    total = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum(_byte_values(lower)[buf] * pw[:len(buf)], out=total[1:])
    return total, inv


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of the bytes of each span."""
    total, inv = prefix_sums(buf, lower)
    return mix((total[ends] - total[starts]) * inv[starts])


def words_of(raw: np.ndarray, off: np.ndarray, i: int, j: int,
             lower: bool = True, breaks: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of documents i..j-1, and where each document's words begin
    (j - i + 1 positions)."""
    base = off[i]
    buf, rel = raw[base:off[j]], off[i:j + 1] - base
    starts, ends = word_bounds(buf, rel, breaks)
    return span_hashes(buf, starts, ends, lower), np.searchsorted(starts, rel)


def shingles_of(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words (one value per start; the last
    ``size - 1`` positions of the array have none)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    h = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        h *= np.uint64(_BASE)
        h += words[k:k + n]
    return mix(h)


def sequence_hash(words: np.ndarray) -> np.uint64:
    """Hash of a whole word sequence shorter than a shingle."""
    h = 0x5851F42D4C957F2D
    for w in words.tolist():
        h = (h * _BASE + w) & 0xFFFFFFFFFFFFFFFF
    return mix(np.array([h], dtype=np.uint64))[0]


def pack(buf: np.ndarray, starts: np.ndarray, lengths: np.ndarray, at: int) -> np.ndarray:
    """Bytes ``at .. at + 7`` of each term as one big-endian word, zeros behind its
    end.  ``buf`` has at least 16 bytes behind the last term."""
    words = np.ndarray(len(buf) - 7, dtype=">u8", buffer=buf, strides=(1,))
    word = words[starts + at].astype(np.uint64)
    short = np.clip(8 - (lengths - at), 0, 7).astype(np.uint64) * np.uint64(8)
    return np.where(lengths > at, word >> short << short, np.uint64(0))
