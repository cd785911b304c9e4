"""Operator 4: benchmark decontamination by spaced-seed hashing.

Texts are lower-cased and cut into words (runs of letters and digits).  Fixed
masks select words; the hash of the words at the selected positions ignores the
others, so a passage whose words were replaced here and there still shares a
hash with its benchmark item.  Test and training hashes are joined, and around
each hit the item is laid over the document on the hit's diagonal and compared
word by word; the best-scoring run of the comparison (a match counts 1, a
mismatch ``-MISMATCH``) must hold enough matching words.

Which masks an item has goes by its words (``item_masks``).  From 16 words on
eight masks of weight 8: few texts share eight words by chance, so hits stay
rare however large the corpus is, and of the runs that are accepted 98.5 % or
more share a seed at every length and number of changed words tried (16 to 60
words, whole or in part, up to a quarter changed; the tests measure it).  From
12 words on four masks of weight 6 (all of the tried ones).  From 5 words on,
too few for the others, ``1111`` and ``11011``, of which every accepted run
holds one: without four matches in a row no stretch of matches exceeds three,
and if of any two stretches around a single mismatch one is a single word, the
score never rises above the first stretch again (3 - 2 + 1 - 2 + 3 = 3), nor
after two mismatches in a row, so the run would be at most three words.
Shorter items are phrases and found only as a whole.

The benchmark side is broadcast while its seeds are within ``MAX_SEEDS``
(their number is counted first); beyond that both sides' seeds meet in a
shuffle join with the same result.

Edge cases: null, empty or word-less texts and items match nothing; very long
texts are searched whole; an empty table or benchmark gives no reports; a null
``doc_id`` is reported as null, a null ``item_id`` likewise; repeated rows give
repeated reports; of equal hits of one item in one document the longest run,
then the earliest, is reported; other columns of the input are ignored by
``contamination`` and kept by ``decontaminate``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words
from .common import arrow_map, saved, scratch_name, small, written

#: The masks, 1 for a position that counts, by the least number
#: of words of the items that have them.
MASKS = {
    16: ("111001010111", "1101010001111", "1101001101011", "1101000110111", "11110010111", "111010011011", "10110101111", "1101100011011"),
    12: ("110100111", "1001010111", "110010111", "1110001101"),
    5: ("1111", "11011"),
    **{n: ("1" * n,) for n in (4, 3, 2, 1)},
}
#: A mismatch costs so many matches when the run around a hit is chosen.
MISMATCH = 2
#: Report a run with so many matching words, or of so much of the item.
MIN_MATCH, MIN_SHARE = 13, 0.75
#: Seeds of the benchmark that are broadcast at most (about 40 bytes each).
MAX_SEEDS = 2_000_000

SCHEMA = "doc_id long, item_id long, n_match long, n_aligned long, item_words long, start_word long"


def _words(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return words.column_bytes(pc.utf8_lower(col))


def seed_hashes(w: np.ndarray, rows: np.ndarray, mask: str) -> tuple[np.ndarray, np.ndarray]:
    """Seed hash at every word position where the mask fits into its row, and
    those positions."""
    span = len(mask)
    n = len(w) - span + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = np.full(n, hash_salt(mask), np.uint64)
    factor = words.ROLL
    for p, bit in enumerate(mask):
        if bit == "1":
            h += w[p : p + n] * factor
            factor = factor * words.BASE
    fits = np.ones(n, bool)
    for edge in rows[1:-1]:
        fits[max(0, edge - span + 1) : edge] = False
    at = np.flatnonzero(fits)
    return words.mix(h[at]), at


def hash_salt(mask: str) -> np.uint64:
    return np.uint64(int(mask, 2) * 0x9E3779B1 + len(mask))


def item_masks(n: int) -> tuple[str, ...]:
    """The masks for an item of ``n`` words."""
    return next((masks for least, masks in MASKS.items() if n >= least), ())


def best_run(same: np.ndarray) -> tuple[int, int, int]:
    """(matches, start, end) of the run with the best score; of equal scores
    the one that ends first, and of those the longest."""
    score = np.zeros(len(same) + 1, np.int64)
    np.cumsum(np.where(same, 1, -MISMATCH), out=score[1:])
    low = np.minimum.accumulate(score)
    end = int(np.argmax(score - low))
    start = int(np.argmax(score[: end + 1] == low[end]))
    return int(same[start:end].sum()), start, end


class Index:
    """Seeds of the benchmark items, sorted by hash."""

    def __init__(self, items: list[np.ndarray], ids: list) -> None:
        self.items, self.ids = items, ids
        hashes, owner, place = [], [], []
        self.masks = sorted({m for w in items for m in item_masks(len(w))})
        for n, w in enumerate(items):
            for mask in item_masks(len(w)):
                h, at = seed_hashes(w, np.array([0, len(w)]), mask)
                hashes.append(h)
                owner.append(np.full(len(h), n))
                place.append(at)
        self.hashes = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        order = np.argsort(self.hashes, kind="stable")
        self.hashes = self.hashes[order]
        self.owner = np.concatenate(owner)[order] if hashes else np.zeros(0, np.int64)
        self.place = np.concatenate(place)[order] if hashes else np.zeros(0, np.int64)
        # a bitmap on 20 bits answers most lookups at once
        self.seen = np.zeros(1 << 20, bool)
        self.seen[self.hashes >> np.uint64(44)] = True

    def hits(self, h: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(word position, item, position in the item) of each shared seed."""
        maybe = np.flatnonzero(self.seen[h >> np.uint64(44)])
        h, at = h[maybe], at[maybe]
        lo, hi = np.searchsorted(self.hashes, h, "left"), np.searchsorted(self.hashes, h, "right")
        for i in np.flatnonzero(hi > lo):
            for k in range(lo[i], hi[i]):
                yield int(at[i]), int(self.owner[k]), int(self.place[k])


def verify(doc: np.ndarray, item: np.ndarray, diagonal: int) -> tuple[int, int, int] | None:
    """(matching words, run length, first word of the run in the document) of
    the item laid over the document at ``diagonal``, if it is contamination."""
    lo, hi = max(0, -diagonal), min(len(item), len(doc) - diagonal)
    n_match, start, end = best_run(doc[lo + diagonal : hi + diagonal] == item[lo:hi])
    if n_match >= MIN_MATCH or n_match >= (MIN_SHARE if len(item) >= 5 else 1) * len(item):
        return n_match, end - start, lo + diagonal + start
    return None


def _best(found: dict, key: tuple, got: tuple[int, int, int]) -> None:
    rank = (-got[0], got[1], got[2])
    if key not in found or rank < found[key][0]:
        found[key] = (rank, got)


def _scan(batches: Iterator[pa.RecordBatch], index: Index) -> Iterator[pa.RecordBatch]:
    """Documents (doc_id, text) to their contamination reports."""
    for batch in batches:
        data, offsets = _words(batch.column(1))
        out: list[tuple] = []
        for i, j in words.slices(offsets):
            w, rows = words.word_hashes(data, offsets, i, j, words.NOT_ALNUM)
            found: dict = {}
            tried = set()
            for mask in index.masks:
                for at, item, place in index.hits(*seed_hashes(w, rows, mask)):
                    r = int(np.searchsorted(rows, at, "right")) - 1
                    diagonal = at - int(rows[r]) - place
                    if (r, item, diagonal) in tried:
                        continue
                    tried.add((r, item, diagonal))
                    got = verify(w[rows[r] : rows[r + 1]], index.items[item], diagonal)
                    if got:
                        _best(found, (i + r, item), got)
            out += [(row, item, got) for (row, item), (_, got) in sorted(found.items())]
        ids = batch.column(0)
        yield _reports([ids[r].as_py() for r, _, _ in out], [index.ids[n] for _, n, _ in out],
                       [g for _, _, g in out], [len(index.items[n]) for _, n, _ in out])


def _reports(doc_ids: list, item_ids: list, got: list[tuple[int, int, int]], lengths: list[int]) -> pa.RecordBatch:
    columns = [doc_ids, item_ids, [g[0] for g in got], [g[1] for g in got], lengths, [g[2] for g in got]]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.int64()) for c in columns],
        names=["doc_id", "item_id", "n_match", "n_aligned", "item_words", "start_word"])


def _seed_rows(batches: Iterator[pa.RecordBatch], masks: tuple[str, ...] | None) -> Iterator[pa.RecordBatch]:
    """(id, text) to one row per seed (seed, id, place).  ``masks`` None: the
    masks of each text's own length."""
    for batch in batches:
        data, offsets = _words(batch.column(1))
        for r in range(batch.num_rows):
            w, _ = words.word_hashes(data, offsets, r, r + 1, words.NOT_ALNUM)
            for mask in item_masks(len(w)) if masks is None else masks:
                h, at = seed_hashes(w, np.array([0, len(w)]), mask)
                for lo in range(0, len(h), 1024):
                    n = len(h[lo : lo + 1024])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h[lo : lo + n].view(np.int64)), pa.array([batch.column(0)[r].as_py()] * n, pa.int64()),
                         pa.array(at[lo : lo + n], pa.int64())], names=["seed", "id", "place"])


def _check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(document, item, diagonals, text, item text) to verified reports, the
    best of each row's diagonals."""
    for batch in batches:
        docs, items = _words(batch.column(3)), _words(batch.column(4))
        keep, got, lengths = [], [], []
        for r, diagonals in enumerate(batch.column(2).to_pylist()):
            doc, _ = words.word_hashes(*docs, r, r + 1, words.NOT_ALNUM)
            item, _ = words.word_hashes(*items, r, r + 1, words.NOT_ALNUM)
            found: dict = {}
            for diagonal in diagonals:
                run = verify(doc, item, diagonal)
                if run:
                    _best(found, (), run)
            if found:
                keep.append(r)
                got.append(found[()][1])
                lengths.append(len(item))
        yield _reports([batch.column(0)[r].as_py() for r in keep], [batch.column(1)[r].as_py() for r in keep], got, lengths)


def _shuffled(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The join of seeds as a shuffle, for a benchmark of any size.  Rows meet
    by row numbers of their own, as ids may be null or repeated."""
    docs = written(docs.withColumn("doc_row", F.monotonically_increasing_id()), "op4_docs")
    items = written(items.withColumn("item_row", F.monotonically_increasing_id()), "op4_items")
    own = arrow_map(items.select("item_row", "text"), partial(_seed_rows, masks=None), "seed long, id long, place long")
    n_words = F.regexp_count("text", F.lit(r"[\p{L}\p{N}]+"))
    lengths = [r[0] for r in items.select(F.least(n_words, F.lit(max(MASKS)))).distinct().collect()]  # at most 17
    masks = tuple(sorted({m for n in lengths for m in item_masks(n)}))
    theirs = arrow_map(docs.select("doc_row", "text"), partial(_seed_rows, masks=masks), "seed long, id long, place long")
    hits = (
        theirs.withColumnsRenamed({"id": "doc_row", "place": "at"})
        .join(own.withColumnRenamed("id", "item_row"), "seed")
        .groupBy("doc_row", "item_row").agg(F.collect_set(F.col("at") - F.col("place")).alias("diagonals"))
    )
    # both texts meet once for each document and item
    texts = hits.join(docs, "doc_row").join(items.withColumnRenamed("text", "item"), "item_row")
    found = arrow_map(texts.select("doc_row", "item_row", "diagonals", "text", "item"), _check, SCHEMA)
    rows = found.withColumnsRenamed({"doc_id": "doc_row", "item_id": "item_row"})
    named = rows.join(docs.select("doc_row", "doc_id"), "doc_row").join(items.select("item_row", "item_id"), "item_row")
    return named.select("doc_id", "item_id", "n_match", "n_aligned", "item_words", "start_word")


def contamination(docs: DataFrame, benchmark: DataFrame, max_seeds: int = MAX_SEEDS) -> DataFrame:
    """Every benchmark item found in every document: (doc_id, item_id,
    n_match, n_aligned, item_words, start_word), the best run of each pair."""
    docs = docs.select("doc_id", "text")
    items = benchmark.select("item_id", "text").where("text is not null")
    n_words = F.regexp_count("text", F.lit(r"[\p{L}\p{N}]+"))
    size = items.agg(F.sum(n_words + 1), F.sum(F.length("text"))).first()
    if max(map(len, MASKS.values())) * (size[0] or 0) > max_seeds or (size[1] or 0) > 16 * max_seeds:
        return _shuffled(docs, items)
    rows = items.collect()  # within max_seeds, checked above
    data, offsets = _words(pa.array([r.text for r in rows], pa.string()))
    hashed = [words.word_hashes(data, offsets, n, n + 1, words.NOT_ALNUM)[0] for n in range(len(rows))]
    index = Index(hashed, [r.item_id for r in rows])
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _scan(batches, shared.value)

    return arrow_map(docs, scan, SCHEMA)


def decontaminate(docs: DataFrame, benchmark: DataFrame, max_seeds: int = MAX_SEEDS) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item, all their
    columns kept.  Rows without a doc_id are reported by no id and stay."""
    mark = scratch_name("contaminated", docs.columns)
    bad = saved(contamination(docs, benchmark, max_seeds).select(F.col("doc_id").alias(mark)).distinct())
    return docs.join(small(bad), F.col("doc_id") == F.col(mark), "left_anti")
