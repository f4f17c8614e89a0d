"""Vectorised word handling on Arrow text columns.

A *word* is a maximal run of bytes outside ``0x20, 0x09-0x0D``.  The functions
work on the UTF-8 buffer of a whole Arrow batch, so Python runs per batch, not
per word.  Hashes are 64-bit polynomial fingerprints (finalised with a mixer);
temporaries are bounded by ``CHUNK`` bytes whatever the length of a text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SEGMENT_BYTES = 2 << 20
CHUNK = 1 << 20

U64 = np.uint64
WS = np.zeros(256, bool)
WS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: lower-cases A-Z only
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.int64).astype(U64) | U64(1)
_tables: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64 (kept, grown by doubling)."""
    t = _tables.get(base)
    if t is None or len(t) < n:
        size = max(CHUNK + 1, 1 << (n - 1).bit_length())
        t = np.empty(size, U64)
        t[0] = 1
        filled = 1
        while filled < size:
            k = min(filled, size - filled)
            t[filled:filled + k] = t[:k] * U64(pow(base, filled, 1 << 64))
            filled += k
        if size > CHUNK + 1 and size > 8 * CHUNK:
            return t
        _tables[base] = t
    return t


def mix(h: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes, offsets) of a string column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, "")
    wide = pa.types.is_large_string(col.type)
    off = np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1] if len(col) else np.zeros(1)
    data = col.buffers()[2] if len(col) else None
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    off = off.astype(np.int64)
    return raw[off[0]:off[-1]], off - off[0]


def segments(col: pa.Array, max_bytes: int = SEGMENT_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of whole texts of about ``max_bytes``; a longer text stands alone."""
    raw, off = text_buffer(col)
    row, n = 0, len(off) - 1
    while row < n:
        end = int(np.searchsorted(off, off[row] + max_bytes, side="right")) - 1
        end = min(max(end, row + 1), n)
        yield row, end, raw[off[row]:off[end]], off[row:end + 1] - off[row]
        row = end


def word_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first word of each text + total) of all words; texts never share a word."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    word = ~WS[data]
    cut = np.zeros(n + 1, bool)
    cut[off] = True
    first = word.copy()
    first[1:] &= ~word[:-1] | cut[1:n]
    last = word
    last[:-1] &= ~word[1:] | cut[1:n]
    starts = np.flatnonzero(first)
    ends = np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, off)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit fingerprints of byte spans given in increasing order."""
    out = np.empty(len(starts), U64)
    i, n = 0, len(starts)
    while i < n:
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + CHUNK, side="right")))
        lo, hi = int(starts[i]), int(ends[j - 1])
        c = np.zeros(hi - lo + 1, U64)
        np.cumsum(_BYTE[data[lo:hi]] * _powers(_BASE, hi - lo)[:hi - lo], out=c[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = (c[e] - c[s]) * _powers(_BASE_INV, hi - lo + 1)[s] + (e - s).astype(U64) * U64(0xD6E8FEB86659FD93)
        i = j
    return mix(out)


def ngram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Fingerprints of all runs of ``n`` consecutive symbols (``len(h) - n + 1`` values)."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, U64)
    out = np.zeros(m, U64)
    if n <= 12:
        for j in range(n):
            out *= U64(0x2545F4914F6CDD1D)
            out += h[j:j + m]
        return mix(out)
    step = max(CHUNK, 4 * n)
    for i in range(0, m, step):  # prefix sums over bounded pieces
        k = min(step, m - i)
        part = h[i:i + k + n - 1]
        c = np.zeros(len(part) + 1, U64)
        np.cumsum(part * _powers(_BASE, len(part))[:len(part)], out=c[1:])
        out[i:i + k] = (c[n:n + k] - c[:k]) * _powers(_BASE_INV, k)[:k]
    return mix(out)


def within(first: np.ndarray, n: int) -> np.ndarray:
    """True for window starts whose ``n`` symbols lie in one text (``first``: first symbol of each text + total)."""
    total = int(first[-1])
    ok = np.zeros(max(total - n + 1, 0), bool)
    if len(ok):
        d = np.zeros(total + 1, np.int64)
        lens = np.diff(first)
        full = lens >= n
        np.add.at(d, first[:-1][full], 1)
        np.add.at(d, first[1:][full] - n + 1, -1)
        ok = np.cumsum(d)[:len(ok)] > 0
    return ok


def counts_in(first: np.ndarray, flags: np.ndarray) -> np.ndarray:
    """Sums of ``flags`` over the ranges that ``first`` delimits."""
    c = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=c[1:])
    return c[first[1:]] - c[first[:-1]]
