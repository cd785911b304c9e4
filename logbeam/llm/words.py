"""Vectorised word hashing of Arrow text columns.

Works on the UTF-8 bytes of a whole column slice at once, so the cost per
document is a share of a few numpy passes, not a Python loop over words.  A
word is a maximal run of bytes that are not ASCII white space
(``[^\\x20\\x09-\\x0D]+``); other word classes pass their own byte table.
Nulls count as empty text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
BASE = U64(0x9E3779B97F4A7C15 | 1)
BASE_INVERSE = U64(pow(int(BASE), -1, 1 << 64))
M1, M2 = U64(0xFF51AFD7ED558CCD), U64(0xC4CEB9FE1A85EC53)
ROLL = U64(0xD6E8FEB86659FD93)

#: Bytes of text worked on at a time: bounds every temporary array.
SLICE_BYTES = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Separators when words are runs of letters and digits (bytes >= 128 count as letters).
NOT_ALNUM = np.array([not (b >= 128 or chr(b).isalnum()) for b in range(256)])
ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32

_powers = [np.ones(1, U64), np.ones(1, U64)]


def _powers_to(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((BASE, BASE_INVERSE)):
            steps = np.full(n, base, U64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=U64)
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (a bijection), in place on a fresh array."""
    x ^= x >> U64(33)
    x *= M1
    x ^= x >> U64(33)
    x *= M2
    x ^= x >> U64(33)
    return x


def column_bytes(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string (UTF-8) or binary column and each row's offsets
    into them."""
    if isinstance(col, pa.ChunkedArray):
        col = pa.concat_arrays(col.chunks) if col.num_chunks != 1 else col.chunk(0)
    binary = pa.types.is_binary(col.type)
    if col.null_count:
        col = pc.fill_null(col, b"" if binary else "")
    col = col.cast(pa.large_binary() if binary else pa.large_string())
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = col.buffers()
    offsets = np.frombuffer(offsets, np.int64)[col.offset : col.offset + len(col) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each (a longer row stands alone)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(n, max(j, i + 1))
        yield i, j
        i = j


def word_spans(data: np.ndarray, row_starts: np.ndarray, separator: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Start and end bytes of every word; rows never share a word."""
    gap = separator[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[row_starts] = True
    edge[len(data)] = True
    before = np.ones(len(data), bool)
    before[1:] = gap[:-1]
    after = np.ones(len(data), bool)
    after[:-1] = gap[1:]
    starts = np.flatnonzero(~gap & (before | edge[:-1]))
    ends = np.flatnonzero(~gap & (after | edge[1:])) + 1
    return starts, ends


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, limit: int = SLICE_BYTES) -> np.ndarray:
    """64-bit hashes of the byte ranges (sorted, not overlapping): equal bytes
    give equal hashes wherever they stand."""
    out = np.empty(len(starts), U64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + limit, side="right")))
        lo, hi = int(starts[i]), int(ends[j - 1])
        up, down = _powers_to(hi - lo + 1)
        terms = data[lo:hi].astype(U64)
        terms += U64(1)
        terms *= up[: hi - lo]
        sums = np.zeros(hi - lo + 1, U64)
        np.cumsum(terms, out=sums[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        h = (sums[e] - sums[s]) * down[s]
        h += (e - s).astype(U64) * ROLL
        out[i:j] = mix(h)
        i = j
    return out


def word_hashes(
    data: np.ndarray, offsets: np.ndarray, i: int, j: int, separator: np.ndarray = SPACE, lower: bool = False
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of rows ``i:j`` and, per row, where they start
    (one more entry than rows)."""
    part = data[offsets[i] : offsets[j]]
    if lower:
        part = ASCII_LOWER[part]
    rows = offsets[i : j + 1] - offsets[i]
    starts, ends = word_spans(part, rows[:-1], separator)
    return hash_spans(part, starts, ends), np.searchsorted(starts, rows)


def shingles(words: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each row's ``k``-word shingles, in order, repeats kept, and
    where each row's start.  A row with fewer words than ``k`` has its whole
    sequence as one shingle; a row without words has none."""
    counts = np.diff(rows)
    n_shingles = np.where(counts >= k, counts - k + 1, (counts > 0).astype(counts.dtype))
    out_rows = np.zeros(len(rows), np.int64)
    np.cumsum(n_shingles, out=out_rows[1:])
    rolled = np.zeros(len(words) + k, U64)
    factor = U64(1)
    for shift in range(min(k, len(words))):
        rolled[: len(words) - shift] += words[shift:] * factor
        factor = factor * ROLL
    first = np.repeat(rows[:-1] - out_rows[:-1], n_shingles)
    at = first + np.arange(out_rows[-1])
    hashes = rolled[at]
    for r in np.flatnonzero((counts > 0) & (counts < k)):
        value, factor = U64(int(counts[r])), U64(1)
        for w in words[rows[r] : rows[r + 1]]:
            value = value + w * factor
            factor = factor * ROLL
        hashes[out_rows[r]] = value
    return mix(hashes), out_rows


def row_minima(values: np.ndarray, rows: np.ndarray, empty: int) -> np.ndarray:
    """The least value of each row; ``empty`` for rows without values."""
    out = np.full(len(rows) - 1, empty, values.dtype)
    full = np.flatnonzero(np.diff(rows) > 0)
    if len(full):
        out[full] = np.minimum.reduceat(values, rows[:-1][full])
    return out


np.seterr(over="ignore")
