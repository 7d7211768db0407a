"""Vectorised byte kernels shared by the text operators (run inside Arrow tasks).

A text column arrives as one Arrow buffer; the helpers below view it as numpy arrays, cut it
into pieces of about half a megabyte at document bounds (one longer document is a piece of its
own, so memory is a fixed multiple of the longest document) and find words, lines and 64-bit
hashes of any byte span without a Python loop over characters.

Hashes are polynomial prefix sums modulo 2**64 with an invertible base: the hash of
``data[s:e]`` is ``(C[e] - C[s]) * base**-s``, mixed with the span's length.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa

U = np.uint64
BASE = 0x9E3779B97F4A7C15  # odd, so invertible modulo 2**64
PIECE = 1 << 19
KEPT = 2 * PIECE  # entries of the power tables that stay in a worker (16 MB)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


VALUES = mix(np.arange(1, 257, dtype=U) * U(BASE))  # one random 64-bit value per byte
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    def run(base):
        p = np.full(n, base, dtype=U)
        p[0] = 1
        return np.multiply.accumulate(p)

    return run(BASE), run(pow(BASE, -1, 1 << 64))


@functools.lru_cache(maxsize=1)
def _kept() -> tuple[np.ndarray, np.ndarray]:
    return _tables(KEPT)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and ``base**-i`` for i in 0..n-1 at least.  One table is kept in a worker
    (16 MB, enough for every piece that is not one long document); larger ones are made for
    their caller and freed with it."""
    return _kept() if n <= KEPT else _tables(n)


def column_bytes(col) -> tuple[np.ndarray, np.ndarray]:
    """A string column as (bytes, offsets); a null is an empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_binary())
    if col.null_count:
        col = col.fill_null(b"")
    if len(col) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, np.int64, len(col) + 1, 8 * col.offset)
    raw = np.empty(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return raw, off


def pieces(col, limit: int = PIECE):
    """Yield ``(first row, rows, bytes, offsets from 0)`` for runs of whole documents."""
    raw, off = column_bytes(col)
    n, lo = len(off) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(off, off[lo] + limit, "right")) - 1
        hi = min(n, max(lo + 1, hi))
        yield lo, hi - lo, raw[off[lo] : off[hi]], off[lo : hi + 1] - off[lo]
        lo = hi


def prefix(data: np.ndarray) -> np.ndarray:
    """Prefix sums for :func:`span_hash`."""
    c = np.zeros(len(data) + 1, U)
    if len(data):
        np.cumsum(VALUES[data] * powers(len(data))[0][: len(data)], out=c[1:])
    return c


def span_hash(c: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    inv = powers(len(c))[1]
    return mix((c[e] - c[s]) * inv[s] + (e - s).astype(U) * U(0xD6E8FEB86659FD93))


def owner(off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The document (row of ``off``) that holds each byte position."""
    return np.searchsorted(off, at, "right") - 1


def runs(inside: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of True bytes; runs never cross documents."""
    if not len(inside):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    before = np.empty(len(inside), bool)
    before[0], before[1:] = True, ~inside[:-1]
    after = np.empty(len(inside), bool)
    after[-1], after[:-1] = True, ~inside[1:]
    edge = off[(off > 0) & (off < len(inside))]
    before[edge] = True
    after[edge - 1] = True
    return np.flatnonzero(inside & before), np.flatnonzero(inside & after) + 1


def words(data: np.ndarray, off: np.ndarray):
    """Words ``[^\\x20\\x09-\\x0D]+``: starts, ends, document of each."""
    s, e = runs(~SPACE[data], off)
    return s, e, owner(off, s)


def per_doc(doc: np.ndarray, n: int, weights=None) -> np.ndarray:
    out = np.bincount(doc, weights=weights, minlength=n)
    return out.astype(np.int64)


def lists(doc: np.ndarray, values: np.ndarray, n: int) -> pa.Array:
    """``values`` (ordered by ``doc``) as one list per document."""
    off = np.zeros(n + 1, np.int32)
    np.cumsum(np.bincount(doc, minlength=n), out=off[1:])
    return pa.ListArray.from_arrays(pa.array(off), pa.array(values))


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(U).view(np.int64)
