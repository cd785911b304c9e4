"""Operator 8: MinHash near-duplicates with circulant signatures.

Two fixed permutations give the whole signature: the first (a 64-bit
bijection, cut to 32 bits) scatters the shingles over a circle of 2^32
places, the second (a 32-bit bijection) orders the circle, and coordinate
``k`` is the least value of the second after the places are shifted around
the circle by ``k``.  Bands of coordinates make candidates; ``near.py``
verifies every candidate on the full shingle sets and links components.

Edge cases: null, empty or white-space texts have an empty set and link with
nothing; a text shorter than a shingle is one shingle; equal sets are linked
by their digest; a very long text is hashed whole, in blocks; ties among hubs go
by a hash of the id, with the same components; an empty table gives no rows; a
null ``doc_id`` links with nothing and its component is
null; rows that repeat a ``doc_id`` are treated as further rows of that
document; other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from functools import partial

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import near, words
from .common import saved, scratch_name, small

#: Shift of the two permutations; fixed so signatures agree between runs.
FIRST, SECOND = 0x5BD1E9955BD1E995, 0x27D4EB2F
#: 32 bands of 5: a pair at similarity 0.8 misses all bands with 3 in a million.
BANDS, BAND_ROWS = 32, 5
#: Places handled at once, so the work stays in the processor's cache.
BLOCK = 1 << 15


def circulant(hashes: np.ndarray, rows: np.ndarray, width: int) -> np.ndarray:
    """Signatures (rows x width) of rows of shingle hashes."""
    out = np.full((len(rows) - 1, width), 0xFFFFFFFF, np.uint32)
    place = (words.mix(hashes ^ np.uint64(FIRST)) >> np.uint64(32)).astype(np.uint32)
    # blocks of whole rows; a longer row is its own block, cut inside
    for i, j in words.slices(rows, BLOCK):
        for lo in range(int(rows[i]), int(rows[j]), BLOCK if j == i + 1 else max(1, int(rows[j] - rows[i]))):
            hi = min(int(rows[j]), lo + BLOCK) if j == i + 1 else int(rows[j])
            part = place[lo:hi]
            at = np.clip(rows[i : j + 1], lo, hi) - lo
            full = np.flatnonzero(np.diff(at) > 0)
            if not len(full):
                continue
            starts = at[:-1][full]
            x, t = np.empty_like(part), np.empty_like(part)
            for c in range(width):
                np.add(part, np.uint32(c), out=x)
                np.right_shift(x, np.uint32(16), out=t)
                np.bitwise_xor(x, t, out=x)
                np.multiply(x, np.uint32(SECOND | 1), out=x)
                np.right_shift(x, np.uint32(15), out=t)
                np.bitwise_xor(x, t, out=x)
                np.multiply(x, np.uint32(0x846CA68B), out=x)
                np.right_shift(x, np.uint32(16), out=t)
                np.bitwise_xor(x, t, out=x)
                least = np.minimum.reduceat(x, starts)
                out[i + full, c] = np.minimum(out[i + full, c], least)
    return out


def near_duplicates(docs: DataFrame, shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of ``docs``:
    documents whose sets of ``shingle_words``-word shingles have a Jaccard
    similarity of ``percent`` / 100 or more are linked; a component is named
    by its smallest doc_id, the document that is kept."""
    width = BANDS * BAND_ROWS
    signed = saved(near.signed_by(docs, partial(circulant, width=width), shingle_words, True, BAND_ROWS))
    found = near.near_components(signed, docs.select("doc_id", "text"), shingle_words, True, percent)
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without its near duplicates: one document of each component
    stays, with all its columns.  Rows without a doc_id stay."""
    found = near_duplicates(docs, shingle_words, percent)
    mark = scratch_name("gone_id", docs.columns)
    gone = saved(found.where("not kept").select(F.col("doc_id").alias(mark)).distinct())
    return docs.join(small(gone), F.col("doc_id") == F.col(mark), "left_anti")
