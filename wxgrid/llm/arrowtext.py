"""Whole texts as byte arrays, words and 64-bit word hashes, inside Arrow tasks.

Arrow hands a batch of texts to a task as one byte buffer with offsets; the
helpers here work on that buffer with numpy, so no per-word Python runs.
A piece holds whole documents of about ``PIECE_BYTES`` together (a longer
document is a piece of its own), which bounds a task's memory by the longest
document and not by the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE_BYTES = 3_000_000
_R = 0x9E3779B97F4A7C15 | 1
_R_INV = pow(_R, -1, 1 << 64)
_pow: dict[int, np.ndarray] = {}


def byte_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; null reads as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_binary())
    if col.null_count:
        col = col.fill_null(b"")
    _, off, data = col.buffers()
    n = len(col)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(off, np.int64)[col.offset:col.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def pieces(offsets: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges [a, b) whose texts hold at most ``limit`` bytes together
    (one row at least)."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """R**i and R**-i modulo 2**64 for i < n, kept per worker up to a piece."""
    have = _pow.get(0)
    if have is None or len(have) < n:
        size = max(n, 1024)
        out = []
        for base in (_R, _R_INV):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            out.append(np.cumprod(p))
        if n > 4 * PIECE_BYTES:  # an unusually long document: not kept
            return out[0][:n], out[1][:n]
        _pow[0], _pow[1] = out
    return _pow[0][:n], _pow[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes (in a new array)."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(32)
    return h


def lower_ascii() -> np.ndarray:
    lut = np.arange(256, dtype=np.uint8)
    lut[65:91] += 32
    return lut


LOWER = lower_ascii()


def word_spans(is_word: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of word bytes; no run crosses a
    document border."""
    n = len(is_word)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    first = is_word.copy()
    first[1:] &= ~is_word[:-1] | cut[1:n]
    last = is_word.copy()
    last[:-1] &= ~is_word[1:] | cut[1:n]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def segment_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte runs [start, end), which are not empty, do
    not overlap and come in order."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    pw, inv = powers(len(buf))
    prod = buf.astype(np.uint64)
    prod += np.uint64(1)
    prod *= pw
    edges = np.empty(2 * len(starts), np.int64)
    edges[0::2], edges[1::2] = starts, ends
    tail = edges[-1] == len(buf)
    sums = np.add.reduceat(prod, edges[:-1] if tail else edges)[0::2]
    sums *= inv[starts]
    sums += (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return mix(sums)


def counts_per_doc(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many of the (sorted) starts lie in each document."""
    return np.diff(np.searchsorted(starts, offsets))
