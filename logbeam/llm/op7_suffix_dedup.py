"""Operator 7: removal of repeated byte strings through suffix arrays.

A byte goes when it is covered by a string of ``length`` bytes (50) that also
starts in a document with a smaller doc_id; strings are judged on the input.

One suffix array over the corpus would have to live somewhere, so the windows
of ``length`` bytes are dealt out by their *minimizer*: of the ``GRAM``-byte
strings inside a window the one with the least hash, which equal windows have
in common.  Successive windows with one minimizer make a segment of a few
dozen bytes, known by its hash.  Equal segments are one string with the
documents that have it: all but the least lose their occurrences of it.  That
is decided within a batch first, so a segment that a third of all documents
have leaves a row per batch and is dealt by its minimizer to one sorted pass.
What can still go is the least document's occurrence, where a different
segment of the same minimizer has the window: the different segments are put
into Burrows-Wheeler transforms, and threshold-bounded interval expansion
(``bwt.py``) finds the classes of windows that are equal.  Each string carries
its places in its least document, so the windows that a lesser document has
go straight back to them.

Savings that leave the result as it is: documents with the same text are one
document with the smallest id, the others lose everything; minimizers that
stand in one document only, and segments that are alone with their minimizer,
are left out by bitmaps of fixed size (``FILTER_BITS``; chance hits only cost
work, a full bitmap only loses the saving).  The segments of a minimizer with
more than ``MAX_GROUP`` bytes of different segments are cut again by the
minimizers of longer strings, up to the window itself, and go the same way.

Segments are told apart by two 64-bit hashes, the minimizer's and their own;
two different ones of a corpus of 10^13 segments agree in both by chance with
a probability of 10^-13.

Edge cases: a null or empty text has no bytes; shorter texts than ``length``
lose nothing; very long texts are cut in overlapping pieces, no window is lost;
of documents with the same string the least doc_id keeps it; an empty table gives
no rows; rows that repeat a doc_id do not remove each other; rows with a
null doc_id lose nothing and remove nothing; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bwt, words
from .common import SMALL_ROWS, arrow_map, saved, shuffle_partitions, small, written

LENGTH, GRAM = 50, 20
#: Strings whose minimizers cut the segments of an oversized minimizer again,
#: before windows themselves do.
LONGER_GRAMS = (28, 40)
FILTER_BITS = 1 << 28  # 32 MB, the bound of what is broadcast
#: Bytes of hash that a minimizer leaves in its part of the hash space.
REST_BYTES = 5
REST_MASK = np.uint64((1 << (8 * REST_BYTES)) - 1)
#: Bytes of different segments in one transform, and of one minimizer.
BATCH_BYTES, MAX_GROUP = 1 << 19, 1 << 19
PLACE_BITS = np.uint64(20)
PLACE_MASK = np.uint64((1 << 20) - 1)
PIECE = (1 << 20) - 2 * LENGTH
#: A range of bytes in one number: its start, and its size in the low bits.
SIZE_BITS = 12
SIZE_MASK = (1 << SIZE_BITS) - 1


def _window_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least value of every window of ``width`` successive values."""
    have = 1
    while have * 2 <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[: len(x) - (width - have)], x[width - have :]) if have < width else x


def segments(data: np.ndarray, rows: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Runs of successive windows with one minimizer: first window, number
    of windows, minimizer hash and row of each.  At most ``PIECE`` +
    ``length`` bytes; rows start at ``rows[:-1]``."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, np.zeros(0, np.uint64), none
    up, down = words._powers_to(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    n = len(data) - gram + 1
    h = words.mix((sums[gram:] - sums[:-gram]) * down[:n])
    key = (h & ~PLACE_MASK) | np.arange(n, dtype=np.uint64)
    place = (_window_min(key, length - gram + 1) & PLACE_MASK).astype(np.int64)
    # windows lie within their row
    ends = np.repeat(rows[1:], np.diff(rows))[: len(place)]
    fits = np.arange(len(place)) + length <= ends
    start = fits.copy()
    start[1:] &= (place[1:] != place[:-1]) | ~fits[:-1]
    first = np.flatnonzero(start)
    stop = np.zeros(len(place) + 1, bool)
    stop[:-1] = start | ~fits
    stop[-1] = True
    stops = np.flatnonzero(stop)
    after = stops[np.searchsorted(stops, first, "right")]
    return first, after - first, h[place[first]], np.searchsorted(rows, first, "right") - 1


def _pieces(data: np.ndarray, offsets: np.ndarray, length: int):
    """Slices of whole rows, a longer row in overlapping pieces: (bytes, row
    starts in them, first row, place of the piece in its row)."""
    for i, j in words.slices(offsets, PIECE):
        lo, hi = int(offsets[i]), int(offsets[j])
        if hi - lo <= PIECE:
            yield data[lo:hi], offsets[i : j + 1] - lo, i, 0
            continue
        for at in range(lo, hi, PIECE):
            part = data[at : min(hi, at + PIECE + length - 1)]
            yield part, np.array([0, len(part)]), i, at - lo


def _part_and_rest(h: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    return (h % np.uint64(parts)).astype(np.int64), (h // np.uint64(parts)) & REST_MASK


def _minimizers(batches: Iterator[pa.RecordBatch], parts: int, length: int, gram: int) -> Iterator[pa.RecordBatch]:
    """Texts to the packed minimizer hashes of each part of the hash space:
    once per batch, twice if two documents of the batch have it."""
    for batch in batches:
        hashes, owners = [], []
        for data, rows, i, _ in _pieces(*words.column_bytes(batch.column(0)), length):
            _, _, h, row = segments(data, rows, length, gram)
            hashes.append(h)
            owners.append(row + i)
        h, row = np.concatenate([*hashes, np.zeros(0, np.uint64)]), np.concatenate([*owners, np.zeros(0, np.int64)])
        order = np.argsort(h, kind="stable")  # rows stay in order within a hash
        h, row = h[order], row[order]
        new = np.ones(len(h), bool)
        new[1:] = h[1:] != h[:-1]
        again = np.zeros(len(h), bool)
        again[1:] = ~new[1:] & (row[1:] != row[:-1])
        twice = np.unique(h[again])
        h = np.concatenate([h[new], twice])
        yield _packed(*_part_and_rest(h, parts), parts)


def _bitmap(batches: Iterator[pa.RecordBatch], slots: int, times: int) -> Iterator[pa.RecordBatch]:
    """Packed hashes to the bitmap of those that came at least ``times``
    (1 or 2) times, per part."""
    got: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        for part, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            wide = np.zeros((len(raw) // REST_BYTES, 8), np.uint8)
            wide[:, :REST_BYTES] = np.frombuffer(raw, np.uint8).reshape(-1, REST_BYTES)
            got.setdefault(part, []).append(wide.view("<u8").ravel())
    parts, maps = [], []
    for part, arrays in got.items():
        h = np.concatenate(arrays)
        if times > 1:
            h = np.sort(h)
            h = h[1:][h[1:] == h[:-1]]
        bits = np.zeros(slots, bool)
        bits[(h % np.uint64(slots)).astype(np.int64)] = True
        parts.append(part)
        maps.append(np.packbits(bits).tobytes())
    yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(maps, pa.binary())], names=["part", "bits"])


def _packed(part: np.ndarray, rest: np.ndarray, parts: int) -> pa.RecordBatch:
    """One row per part: the hashes' rests, packed."""
    order = np.argsort(part, kind="stable")
    part, rest = part[order], rest[order]
    cuts = np.searchsorted(part, np.arange(parts + 1))
    raw = rest.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :REST_BYTES]
    used = np.flatnonzero(np.diff(cuts))
    return pa.RecordBatch.from_arrays(
        [pa.array(used, pa.int32()), pa.array([raw[cuts[p] : cuts[p + 1]].tobytes() for p in used], pa.binary())],
        names=["part", "hashes"])


def _pack_keys(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield _packed(*_part_and_rest(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64), parts), parts)


class KeyFilter:
    """Bitmap of 64-bit keys; ``may_hold`` says which keys may be in it."""

    def __init__(self, packed: DataFrame, parts: int, times: int) -> None:
        slots = max(8, FILTER_BITS // parts // 8 * 8)
        self.parts, self.slots = parts, slots
        self.bits = np.zeros((parts, slots // 8), np.uint8)
        dealt = packed.repartitionById(parts, "part")
        for row in arrow_map(dealt, partial(_bitmap, slots=slots, times=times), "part int, bits binary").collect():
            self.bits[row.part] = np.frombuffer(row.bits, np.uint8)

    def may_hold(self, h: np.ndarray) -> np.ndarray:
        part, rest = _part_and_rest(h, self.parts)
        slot = (rest % np.uint64(self.slots)).astype(np.int64)
        return (self.bits[part, slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1 == 1


PACKED = "part int, hashes binary"


def shared_minimizers(texts: DataFrame, length: int, gram: int) -> KeyFilter:
    """The minimizers that may stand in two documents."""
    parts = shuffle_partitions(texts.sparkSession)
    packed = arrow_map(texts.select("text"), partial(_minimizers, parts=parts, length=length, gram=gram), PACKED)
    return KeyFilter(packed, parts, 2)


def key_filter(keys: DataFrame) -> KeyFilter:
    """The filter of a column of 64-bit keys."""
    parts = shuffle_partitions(keys.sparkSession)
    return KeyFilter(arrow_map(keys, partial(_pack_keys, parts=parts), PACKED), parts, 1)


def _segment_hashes(data: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hashes of byte ranges that may overlap."""
    up, down = words._powers_to(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    h = (sums[first + size] - sums[first]) * down[first]
    return words.mix(h + size.astype(np.uint64) * words.ROLL)


def _found(batch: pa.RecordBatch, wanted: KeyFilter, length: int, gram: int):
    """The segments of a batch (doc_id, tkey, text) whose minimizers may be
    wanted: bytes of the piece, place of the piece, rows, and per segment its
    first byte, size, minimizer, hash and row."""
    for data, rows, i, at in _pieces(*words.column_bytes(batch.column(2)), length):
        first, count, m, row = segments(data, rows, length, gram)
        some = np.flatnonzero(wanted.may_hold(m))
        first, size, m, row = first[some], count[some] + length - 1, m[some], row[some]
        yield data, at, rows, i, first, size, m, _segment_hashes(data, first, size), row


OCCURRENCES = "m long, s long, doc_id long, tkey long, place long, gone boolean"


def _occurrences(batches: Iterator[pa.RecordBatch], wanted, length: int, gram: int) -> Iterator[pa.RecordBatch]:
    """Occurrences of shared segments (``OCCURRENCES``); m is the minimizer's
    hash, s the segment's, ``place`` its first byte and size in one number.
    Of the documents of a batch with the same segment the least one's are
    given; those of the others go, and are given as merged ranges."""
    for batch in batches:
        ids, keys = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
        found = [
            (m, s, i + row, at + first - rows[row], size)
            for _, at, rows, i, first, size, m, s, row in _found(batch, wanted.value, length, gram)]
        if not found:
            continue
        m, s, row, start, size = (np.concatenate(c) for c in zip(*found, strict=True))
        order = np.lexsort((ids[row], s, m))
        m, s, row, start, size = m[order], s[order], row[order], start[order], size[order]
        gone = ids[row] != _group_least(_group_starts(m, s), ids[row])
        at, lo, hi = _merged_by_row(row[gone], start[gone], start[gone] + size[gone])
        kept = ~gone
        owner = np.concatenate([row[kept], at])
        # ranges that go are dealt by their document
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([m[kept], words.mix(ids[at].astype(np.uint64))]).view(np.int64)),
             pa.array(np.concatenate([s[kept], np.zeros(len(at), np.uint64)]).view(np.int64)), pa.array(ids[owner]), pa.array(keys[owner]),
             pa.array(np.concatenate([(start[kept] << SIZE_BITS) | size[kept], (lo << SIZE_BITS) | (hi - lo)])),
             pa.array(np.arange(len(owner)) >= kept.sum())],
            names=[c.split()[0] for c in OCCURRENCES.split(", ")])


def _group_starts(m: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Where a new (m, s) begins."""
    new = np.ones(len(m), bool)
    new[1:] = (m[1:] != m[:-1]) | (s[1:] != s[:-1])
    return new


def _group_least(new: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """The first, and least, document of each row's group."""
    return doc[np.flatnonzero(new)][np.cumsum(new) - 1]


def _merged_by_row(row: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges of rows to their maximal runs, in pieces that fit a place."""
    if not len(row):
        return row, lo, hi
    stride = int(hi.max()) + 2
    a, b = merged(row * stride + lo, row * stride + hi)
    pieces = -(-(b - a) // SIZE_MASK)
    number = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    a, b = np.repeat(a, pieces) + number * SIZE_MASK, np.repeat(b, pieces)
    b = np.minimum(b, a + SIZE_MASK)
    owner = a // stride
    return owner, a - owner * stride, b - owner * stride


SETTLED = "m long, doc_id long, tkey long, place long"


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences sorted by (m, s, doc_id) to the places that go, as a lesser
    document has the same segment, and to the minimizers with different
    segments (rows with m alone)."""
    last = None  # m, s and least document of the group that may go on
    for batch in batches:
        if not batch.num_rows:
            continue
        m, s, doc, tkey, place = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(5))
        gone = batch.column(5).to_numpy(zero_copy_only=False)
        new = _group_starts(m, s)
        same_m = np.concatenate([[last is not None and last[0] == m[0]], m[1:] == m[:-1]])
        if last is not None and last[:2] == (m[0], s[0]):
            new[0] = False
        group = np.cumsum(new)
        least = np.concatenate([[doc[0] if last is None else last[2]], doc[np.flatnonzero(new)]])[group]
        last = (m[-1], s[-1], least[-1])
        removed = gone | (doc > least)
        many = np.unique(m[new & same_m & ~gone])
        yield pa.RecordBatch.from_arrays(
            [pa.concat_arrays([pa.nulls(int(removed.sum()), pa.int64()), pa.array(many)]),
             *(pa.concat_arrays([pa.array(c[removed]), pa.nulls(len(many), pa.int64())]) for c in (doc, tkey, place))],
            names=["m", "doc_id", "tkey", "place"])


STRINGS = "m long, s long, segment binary, doc_id long, tkey long, place long"


def _strings_of(data, first, size, m, s, doc, tkey, start, every: bool = False) -> pa.RecordBatch | None:
    """Segments (byte ranges of ``data``) as rows of ``STRINGS``: of each the
    places in its least document (``every``: in all), the bytes with the first."""
    order = np.lexsort((doc, s, m))
    first, size, m, s, doc, tkey, start = (c[order] for c in (first, size, m, s, doc, tkey, start))
    if not len(m):
        return None
    kept = every | (doc == _group_least(_group_starts(m, s), doc))
    first, size, m, s, doc, tkey, start = (c[kept] for c in (first, size, m, s, doc, tkey, start))
    new = _group_starts(m, s)
    text, offsets = _gathered(data, first, np.where(new, size, 0))
    valid = pa.py_buffer(np.packbits(new, bitorder="little").tobytes())
    segment = pa.BinaryArray.from_buffers(pa.binary(), len(m), [valid, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(text)])
    return pa.RecordBatch.from_arrays(
        [pa.array(m.view(np.int64)), pa.array(s.view(np.int64)), segment, pa.array(doc), pa.array(tkey), pa.array((start << SIZE_BITS) | size)],
        names=[c.split()[0] for c in STRINGS.split(", ")])


def _strings(batches: Iterator[pa.RecordBatch], wanted, length: int, gram: int) -> Iterator[pa.RecordBatch]:
    """The different segments of a batch of texts, see ``_strings_of``."""
    for batch in batches:
        ids, keys = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
        pieces, columns, at = [], [], 0
        for data, place, rows, i, first, size, m, s, row in _found(batch, wanted.value, length, gram):
            pieces.append(data)
            columns.append((at + first, size, m, s, ids[i + row], keys[i + row], place + first - rows[row]))
            at += len(data)
        if columns:
            out = _strings_of(np.concatenate(pieces), *(np.concatenate(c) for c in zip(*columns, strict=True)))
            if out is not None:
                yield out


def _recut(batches: Iterator[pa.RecordBatch], length: int, gram: int) -> Iterator[pa.RecordBatch]:
    """Segments of an oversized minimizer (doc_id, tkey, place, segment) cut
    again by the minimizers of longer strings."""
    for batch in batches:
        ids, keys, places = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(3))
        data, offsets = words.column_bytes(batch.column(3))
        for i, j in words.slices(offsets, PIECE):
            part, rows = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
            first, count, m, row = segments(part, rows, length, gram)
            size = count + length - 1
            out = _strings_of(
                part, first, size, m, _segment_hashes(part, first, size), ids[i + row], keys[i + row], (places[i + row] >> SIZE_BITS) + first - rows[row],
                every=True)
            if out is not None:
                yield out


def _gathered(data: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte ranges one after the other, and where each starts."""
    offsets = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=offsets[1:])
    return data[np.repeat(first - offsets[:-1], size) + np.arange(offsets[-1])], offsets


RESOLVED = "doc_id long, tkey long, place long, segment binary"


def _resolved(doc, tkey, place, segment=None) -> pa.RecordBatch:
    segment = pa.nulls(len(doc), pa.binary()) if segment is None else segment
    return pa.RecordBatch.from_arrays(
        [pa.array(doc, pa.int64()), pa.array(tkey, pa.int64()), pa.array(place, pa.int64()), segment], names=["doc_id", "tkey", "place", "segment"])


def _transform(segment: pa.Array, low: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Different segments (of whole minimizers) to the runs of their windows
    that a lesser document than the segment's own has: segment, first window,
    windows."""
    data, offsets = words.column_bytes(segment)
    lengths = np.diff(offsets)
    # each string with one byte behind it for its end
    first = np.zeros(len(lengths), np.int64)
    np.cumsum(lengths[:-1] + 1, out=first[1:])
    joined = np.zeros(int((lengths + 1).sum()), np.uint8)
    text, _ = _gathered(data, offsets[:-1], lengths)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    joined[np.arange(len(text)) + owner] = text
    classes = bwt.prefix_classes(joined, first, lengths, length)
    counts = lengths - length + 1
    owner = np.repeat(np.arange(len(lengths)), counts)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    own = classes[first[owner] + offset]
    by_class = np.argsort(own, kind="stable")
    starts = np.flatnonzero(np.concatenate([[True], np.diff(own[by_class]) != 0]))
    least = np.empty(len(own), np.int64)
    least[by_class] = np.repeat(np.minimum.reduceat(low[owner[by_class]], starts), np.diff(np.concatenate([starts, [len(own)]])))
    goes = least < low[owner]
    new = goes.copy()
    new[1:] &= ~goes[:-1] | (owner[1:] != owner[:-1])
    runs = np.flatnonzero(new)
    sizes = np.add.reduceat(goes.astype(np.int64), runs) if len(runs) else runs
    return owner[runs], offset[runs], sizes


def _resolve(batches: Iterator[pa.RecordBatch], length: int, batch_bytes: int, max_group: int, equal: bool) -> Iterator[pa.RecordBatch]:
    """Segments (``STRINGS``) sorted by (m, s, doc_id, bytes first) to the
    places that go; the segments of an oversized minimizer are passed on as
    they are, with their bytes.  ``equal``: places in other documents than the
    segment's least go too (they are not settled yet)."""
    waiting: list[pa.RecordBatch] = []
    size, big, last = 0, None, None

    def least_rows(table: pa.Table, out: list) -> tuple[pa.Table, np.ndarray]:
        """The rows of each segment's least document, and where segments begin."""
        m, s, doc, tkey, place = (table.column(c).to_numpy() for c in (0, 1, 3, 4, 5))
        keep = doc == _group_least(_group_starts(m, s), doc)
        if equal and not keep.all():
            out.append(_resolved(doc[~keep], tkey[~keep], place[~keep]))
        table = table.filter(pa.array(keep))
        return table, _group_starts(m[keep], s[keep])

    def settle(table: pa.Table, out: list) -> None:
        table, new = least_rows(table, out)
        m, doc, tkey, place = (table.column(c).to_numpy() for c in (0, 3, 4, 5))
        starts = np.flatnonzero(new)
        segment = table.column(2).combine_chunks().take(pa.array(starts))
        if isinstance(segment, pa.ChunkedArray):
            segment = segment.combine_chunks()
        lengths = pc.binary_length(segment).to_numpy(zero_copy_only=False).astype(np.int64)
        heads = m[starts]
        first = np.flatnonzero(np.concatenate([[True], heads[1:] != heads[:-1]]))
        count = np.diff(np.concatenate([first, [len(heads)]]))
        group_bytes = np.add.reduceat(lengths, first)
        # one segment alone has nothing to be compared with
        whole = np.repeat((count > 1) & (group_bytes <= max_group), count)
        over = np.repeat((count > 1) & (group_bytes > max_group), count)
        places = np.diff(np.concatenate([starts, [len(m)]]))
        for part in _chunks(np.flatnonzero(whole), heads, lengths, batch_bytes):
            k, lo, n = _transform(segment.take(pa.array(part)), doc[starts[part]], length)
            k = part[k]
            run = np.repeat(np.arange(len(k)), places[k])
            at = np.repeat(starts[k], places[k]) + np.arange(len(run)) - np.repeat(np.cumsum(places[k]) - places[k], places[k])
            out.append(_resolved(doc[at], tkey[at], (((place[at] >> SIZE_BITS) + lo[run]) << SIZE_BITS) | (n[run] + length - 1)))
        if over.any():
            of = np.cumsum(new) - 1
            at = np.flatnonzero(over[of])
            out.append(_resolved(doc[at], tkey[at], place[at], segment.take(pa.array(of[at]))))

    def pass_on(batch: pa.RecordBatch, out: list) -> None:
        """Rows of the oversized minimizer, whose last segment may go on."""
        nonlocal last
        s, doc, tkey, place = (batch.column(c).to_numpy(zero_copy_only=False) for c in (1, 3, 4, 5))
        new = np.ones(len(s), bool)
        new[1:] = s[1:] != s[:-1]
        if last is not None and last[0] == s[0]:
            new[0] = False
        starts, group = np.flatnonzero(new), np.cumsum(new)
        lows = np.concatenate([[doc[0] if last is None else last[1]], doc[starts]])
        texts = pa.concat_arrays([pa.array([None if last is None else last[2]], pa.binary()), batch.column(2).take(pa.array(starts))])
        keep = doc == lows[group]
        if equal and not keep.all():
            out.append(_resolved(doc[~keep], tkey[~keep], place[~keep]))
        out.append(_resolved(doc[keep], tkey[keep], place[keep], texts.take(pa.array(group[keep]))))
        last = (s[-1], lows[group[-1]], texts[int(group[-1])].as_py())

    for batch in batches:
        out: list[pa.RecordBatch] = []
        if big is not None and batch.num_rows:
            m = batch.column(0).to_numpy()
            n = int(np.searchsorted(m != big, True)) if (m != big).any() else len(m)
            if n:
                pass_on(batch.slice(0, n), out)
            batch = batch.slice(n)
            if batch.num_rows:
                big, last = None, None
        if batch.num_rows:
            waiting.append(batch)
            size += batch.column(2).nbytes
        if size >= batch_bytes:
            table = pa.Table.from_batches(waiting)
            m = table.column(0).to_numpy()
            edge = int(np.searchsorted(m == m[-1], True))  # the last minimizer may go on
            if edge:
                settle(table.slice(0, edge), out)
            table = table.slice(edge)
            if table.nbytes > 2 * max_group + batch_bytes:
                table, new = least_rows(table, out)
                if pc.sum(pc.binary_length(table.column(2))).as_py() > max_group:
                    big, last = table.column(0)[0].as_py(), None
                    for b in table.to_batches():
                        pass_on(b, out)
                    table = table.slice(0, 0)
            waiting = [b for b in table.to_batches() if b.num_rows]
            size = sum(b.column(2).nbytes for b in waiting)
        yield from out
    if waiting:
        out = []
        settle(pa.Table.from_batches(waiting), out)
        yield from out


def _chunks(rows: np.ndarray, m: np.ndarray, size: np.ndarray, batch_bytes: int) -> Iterator[np.ndarray]:
    """Rows of whole minimizers, about ``batch_bytes`` at a time."""
    if not len(rows):
        return
    group = np.cumsum(np.concatenate([[0], m[rows][1:] != m[rows][:-1]]))
    upto = np.cumsum(size[rows])
    first_of = np.flatnonzero(np.concatenate([[True], np.diff(group) != 0]))
    part = (upto[first_of] // max(batch_bytes, 1))[group]
    cuts = np.flatnonzero(np.diff(part)) + 1
    yield from np.split(rows, cuts)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, tkey, ranges packed as start and size) to maximal runs."""
    for batch in batches:
        cuts, packed = batch.column(2).offsets.to_numpy(), batch.column(2).values.to_numpy(zero_copy_only=False)
        lo, hi = packed >> SIZE_BITS, (packed >> SIZE_BITS) + (packed & SIZE_MASK)
        out = [merged(lo[a:b], hi[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        offsets = pa.array(np.concatenate([[0], np.cumsum([len(x) for x, _ in out])]).astype(np.int32))
        parts = [np.concatenate([*(x[k] for x in out), np.zeros(0, np.int64)]) for k in (0, 1)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), *(pa.ListArray.from_arrays(offsets, pa.array(p, pa.int64())) for p in parts)],
            names=["doc_id", "tkey", "starts", "ends"])


def merged(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte ranges as the maximal runs they cover."""
    order = np.argsort(lo, kind="stable")
    lo, reach = lo[order], np.maximum.accumulate(hi[order])
    starts = np.flatnonzero(np.concatenate([[True], lo[1:] > reach[:-1]]))
    return lo[starts], np.concatenate([reach[starts[1:] - 1], reach[-1:]])


def removed_ranges(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, batch_bytes: int = BATCH_BYTES, max_group: int = MAX_GROUP
) -> DataFrame:
    """(doc_id, tkey, starts, ends): the maximal byte runs that go, for the
    documents that lose any.  ``docs`` (doc_id, tkey, text)."""
    texts = docs.where("doc_id is not null")
    ids = saved(texts.select("doc_id", "tkey", F.md5("text").alias("digest"), F.octet_length("text").cast("long").alias("n")))
    firsts = ids.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("c")).where("c > 1")
    copies = saved(ids.join(firsts, "digest").where("doc_id != first").select("doc_id", "tkey", "n").distinct())
    single = texts.join(small(copies.select("doc_id", "tkey")), ["doc_id", "tkey"], "left_anti").where(F.octet_length("text") >= length)

    spark = docs.sparkSession
    rows = single.select("doc_id", "tkey", "text")

    def cut(work, wanted: KeyFilter, schema: str) -> DataFrame:
        sent = spark.sparkContext.broadcast(wanted)
        return arrow_map(rows, lambda batches: work(batches, sent, length, gram), schema)

    parts = shuffle_partitions(spark)
    occurrences = cut(_occurrences, shared_minimizers(single, length, gram), OCCURRENCES)
    settled = written(arrow_map(occurrences.repartition(parts, "m").sortWithinPartitions("m", "s", "doc_id"), _settle, SETTLED), "settled")
    gone = [settled.where("m is null").select("doc_id", "tkey", "place")]
    strings = cut(_strings, key_filter(settled.where("m is not null").select("m")), STRINGS)
    for step, longer in enumerate([*(g for g in LONGER_GRAMS if gram < g < length), length, None]):
        ordered = strings.repartition(parts, "m").sortWithinPartitions("m", "s", "doc_id", F.col("segment").isNull())
        work = partial(_resolve, length=length, batch_bytes=batch_bytes, max_group=max_group, equal=step > 0)
        resolved = saved(arrow_map(ordered, work, RESOLVED))
        gone.append(resolved.where("segment is null").select("doc_id", "tkey", "place"))
        over = resolved.where("segment is not null")
        if over.isEmpty():
            break
        strings = arrow_map(over.select("doc_id", "tkey", "place", "segment"), partial(_recut, length=length, gram=longer), STRINGS)
    gone = reduce(DataFrame.union, gone).withColumnRenamed("place", "range")
    gathered = gone.groupBy("doc_id", "tkey").agg(F.collect_list("range").alias("ranges"))
    ranges = arrow_map(gathered, _merge, "doc_id long, tkey long, starts array<long>, ends array<long>")
    whole = copies.where(F.col("n") >= length).select(
        "doc_id", "tkey", F.array(F.lit(0).cast("long")).alias("starts"), F.array("n").alias("ends"))
    return written(ranges.union(whole), "ranges")


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = words.column_bytes(batch.column(1))
        cuts = batch.column(2).offsets.to_numpy()
        all_lo, all_hi = (batch.column(c).values.to_numpy(zero_copy_only=False) for c in (2, 3))
        gone, digests = [], []
        for r in range(batch.num_rows):
            lo, hi = all_lo[cuts[r] : cuts[r + 1]], all_hi[cuts[r] : cuts[r + 1]]
            text = data[offsets[r] : offsets[r + 1]].tobytes()
            digest = hashlib.sha256()
            for a, b in zip([0, *hi.tolist()], [*lo.tolist(), len(text)], strict=True):
                digest.update(text[a:b])
            gone.append(int((hi - lo).sum()))
            digests.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.diff(offsets), pa.int64()), pa.array(gone, pa.int64()),
             pa.array(np.diff(cuts), pa.int64()), pa.array(digests, pa.string())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def remove_repeats(docs: DataFrame, length: int = LENGTH, **options) -> DataFrame:
    """One row per document, see ``RESULT``."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text"))
    # rows of one id are told apart by their texts
    often = saved(rows.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("doc_id", "c"))
    keyed = rows.join(small(often), "doc_id", "left")
    rows = keyed.select("doc_id", F.when(F.col("c") > 1, F.xxhash64("text")).otherwise(F.lit(0)).alias("tkey"), "text")
    ranges = removed_ranges(rows, length, **options)
    key = ["doc_id", "tkey"]
    none = F.lit(0).cast("long")
    if (ranges.agg(F.sum(F.size("starts"))).first()[0] or 0) <= SMALL_ROWS:  # few runs: the texts stay where they are
        joined = rows.join(F.broadcast(ranges), key, "left")
        touched, clean = joined.where("starts is not null"), joined.where("starts is null")
    else:
        ids = small(ranges.select(*key))
        touched = rows.join(ids, key, "left_semi").join(ranges, key)
        clean = rows.join(ids, key, "left_anti")
    unchanged = clean.select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), none.alias("n_removed"), none.alias("n_spans"),
        F.sha2("text", 256).alias("kept_sha256"))
    return unchanged.union(arrow_map(touched.select("doc_id", "text", "starts", "ends"), _removed, RESULT))
