"""Operator 9: MinHash document fingerprints.

A fingerprint is ``PERMUTATIONS`` MinHash coordinates of a text's five-word
shingles under universal hash permutations ``(a x + b) mod 2^64``, of which the
upper 32 bits count, written as hexadecimal; all texts of an Arrow slice are
hashed at once in numpy.  The likeness of two fingerprints is the share of
equal coordinates.

``fingerprints`` gives each document's fingerprint and that of its edited
text: the last third of its code points replaced by as many of the start of
the next document in descending doc_id order, the first after the last.  The
documents are dealt into id ranges (bounds from quantiles), each range is one
task that streams its documents in order, and the first document of a range
is sent along to the range before it: texts are shuffled once, whatever the
table's size, and no task holds more than two texts.

``near_duplicates`` joins bands of the signatures and verifies every candidate
on the full shingle sets (``near.py``).

Edge cases: a null text counts as empty; texts without a word share the
fingerprint of the empty set, likeness 1 to each other; a text of fewer than
five words is one shingle; rows that repeat a doc_id follow each other in text
order, so ties have one order; rows with a null doc_id come last; a single row is
its own next; very long texts are hashed whole; an empty table gives no rows; other
columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import near, words
from .common import arrow_map, saved, shuffle_partitions

PERMUTATIONS, SHINGLE_WORDS, SEED = 64, 5, 9
#: 16 bands of 4 coordinates: a pair at 0.8 misses all with 2 in 10,000.
BAND_ROWS = 4
EMPTY = 0xFFFFFFFF
#: Shingles handled at once, so the work stays in the processor's cache.
BLOCK = 1 << 15
#: Rows are worked on when so many characters have come together.
FLUSH_CHARS = 1 << 19


def permutations(width: int = PERMUTATIONS, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    odd = rng.integers(0, 1 << 63, width, np.uint64) * np.uint64(2) + np.uint64(1)
    return odd, rng.integers(0, 1 << 63, width, np.uint64)


def minhash(hashes: np.ndarray, rows: np.ndarray, width: int = PERMUTATIONS) -> np.ndarray:
    """Signatures (rows x width) of rows of shingle hashes; rows without
    shingles have the empty signature."""
    a, b = permutations(width)
    out = np.full((len(rows) - 1, width), EMPTY, np.uint32)
    for i, j in words.slices(rows, BLOCK):
        step = BLOCK if j == i + 1 else max(1, int(rows[j] - rows[i]))
        for lo in range(int(rows[i]), int(rows[j]), step):
            hi = min(int(rows[j]), lo + step)
            part = hashes[lo:hi]
            at = np.clip(rows[i : j + 1], lo, hi) - lo
            full = np.flatnonzero(np.diff(at) > 0)
            starts = at[:-1][full]
            x, y = np.empty_like(part), np.empty(len(part), np.uint32)
            for c in range(width):
                np.multiply(part, a[c], out=x)
                np.add(x, b[c], out=x)
                np.right_shift(x, np.uint64(32), out=x)
                y[:] = x
                out[i + full, c] = np.minimum(out[i + full, c], np.minimum.reduceat(y, starts))
    return out


def signatures(texts: list[str]) -> np.ndarray:
    data, offsets = words.column_bytes(pa.array(texts, pa.string()))
    out = np.empty((len(texts), PERMUTATIONS), np.uint32)
    for i, j in words.slices(offsets):
        out[i:j] = minhash(*words.shingles(*words.word_hashes(data, offsets, i, j), SHINGLE_WORDS))
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal coordinates, row by row."""
    return (a == b).mean(axis=1)


def edited_text(text: str, following: str) -> str:
    """``text`` with its last third replaced by the start of ``following``."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _rows(ids: list, texts: list[str]) -> pa.RecordBatch:
    """Results of all rows but the last, each followed by its next."""
    edited = [edited_text(a, b) for a, b in zip(texts, texts[1:], strict=False)]
    own, new = signatures(texts), signatures(edited)
    n = len(edited)

    def written(s: np.ndarray) -> list[str]:
        return [r.astype(">u4").tobytes().hex() for r in s]

    return pa.RecordBatch.from_arrays([
        pa.array(ids[:n], pa.int64()), pa.array([len(t) for t in texts[:n]], pa.int64()),
        pa.array([hashlib.sha256(t.encode("utf-8")).hexdigest() for t in edited], pa.string()),
        pa.array(written(own[:n]), pa.string()), pa.array(written(new), pa.string()),
        pa.array(likeness(own[:n], new), pa.float64()), pa.array(likeness(own[:n], own[1:]), pa.float64()),
    ], names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (range, guest, doc_id, text) of some ranges, each range in order
    with the next range's first document after it as a guest."""
    ids, texts, place, ended, size = [], [], None, False, 0
    for batch in batches:
        for z, guest, doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            text = text or ""
            if z != place:
                if len(ids) > 1:
                    yield _rows(ids, texts)
                ids, texts, place, ended, size = [], [], z, False, 0
            if ended:
                continue  # one guest is enough
            ids.append(doc_id)
            texts.append(text)
            size += len(text)
            ended = guest
            if size >= FLUSH_CHARS and len(ids) > 1:
                yield _rows(ids, texts)
                ids, texts, size = ids[-1:], texts[-1:], len(texts[-1])
    if len(ids) > 1:
        yield _rows(ids, texts)


def _range_of(doc_id: Column, cuts: list[int]) -> Column:
    """How many of the cuts (descending) lie above the id, found in two
    steps of about sqrt(cuts) comparisons; null ids come after all."""
    step = max(1, round(len(cuts) ** 0.5))
    groups = [cuts[k : k + step] for k in range(0, len(cuts), step)] or [[]]

    def longs(values: list[int]) -> Column:
        return F.array(*(F.lit(v).cast("long") for v in values)).cast("array<long>")

    whole = F.size(F.filter(longs([g[-1] for g in groups if g]), lambda c: c > doc_id))
    inside = F.size(F.filter(F.get(F.array(*map(longs, groups)), whole), lambda c: c > doc_id))
    return F.when(doc_id.isNull(), len(cuts) + 1).otherwise(
        F.least(whole * step, F.lit(len(cuts))) + F.greatest(F.coalesce(inside, F.lit(0)), F.lit(0))).cast("int")


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per document, see ``SCHEMA``; ``near_edited`` and ``near_next``
    are the likeness to the edited text's and the next document's
    fingerprint."""
    spark = docs.sparkSession
    n = shuffle_partitions(spark)
    docs = docs.select("doc_id", "text")
    # more ranges than tasks evens them out; the bounds only balance the work
    cuts = docs.agg(F.percentile_approx("doc_id", [k / (4 * n) for k in range(1, 4 * n)], 10_000)).first()[0] or []
    dealt = docs.withColumn("range", _range_of(F.col("doc_id"), sorted(set(cuts), reverse=True)))
    # the first document of each range that has one: at most 4 n rows
    heads = dealt.groupBy("range").agg(F.max("doc_id").alias("head")).orderBy("range").collect()
    before = [(h.range, h.head, heads[k - 1].range) for k, h in enumerate(heads)]  # the last range goes on with the first's head
    if not before:
        return spark.createDataFrame([], SCHEMA)
    hosts = F.broadcast(spark.createDataFrame(before, "head_range int, head long, host int"))
    is_head = (F.col("range") == F.col("head_range")) & F.col("doc_id").eqNullSafe(F.col("head"))
    places = F.array(
        F.struct("range", F.lit(False).alias("guest")), F.struct(F.col("host").alias("range"), F.lit(True).alias("guest")))
    sent = dealt.join(hosts, is_head, "left").select(
        F.inline(F.filter(places, lambda p: p["range"].isNotNull())), "doc_id", "text")
    ordered = sent.repartitionById(n, F.col("range") % n).sortWithinPartitions(
        "range", "guest", F.desc_nulls_last("doc_id"), F.coalesce("text", F.lit("")))
    return arrow_map(ordered.select("range", "guest", "doc_id", "text"), _in_order, SCHEMA)


def near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) per document: signature bands are
    joined, candidates verified on the full five-word shingle sets."""
    signed = saved(near.signed_by(docs, partial(minhash, width=PERMUTATIONS), SHINGLE_WORDS, False, BAND_ROWS))
    return near.near_components(signed, docs.select("doc_id", "text"), SHINGLE_WORDS, False, percent)
