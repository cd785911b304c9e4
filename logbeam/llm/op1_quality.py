"""Operator 1: quality classifier on random-indexing word vectors.

Texts are cut into tokens: runs of letters, runs of digits, runs of
punctuation.  Each token is two vocabulary items, its lower-cased text and its
shape (kind, case, length class); items are hashed into ``VOCABULARY``
buckets, so every table has a fixed size.  Random indexing: each bucket has a
fixed sparse random vector (``NONZERO`` entries of +1 or -1 out of ``DIM``),
and a bucket's word vector is the sum of the random vectors of the items
around its occurrences in the whole corpus, scaled to length one.  A document
is the mean of its items' word vectors (words and shapes apart) with three
plain statistics beside it.  A two-layer network in numpy, trained on
labelled documents, gives a logit; a temperature fitted on labelled rows that
the network did not see turns it into a calibrated probability.

Corpus statistics come from all documents.  The network is fitted on at most
``max_labelled`` labelled rows, chosen by a hash of their id.  Labels, lang,
source and doc_id are never inputs of a score.

Edge cases: a null or empty text has the zero vector and a score like any
other text; a null doc_id is scored, is not held out and never trains;
labels that are null or not 0/1 do not train; rows that repeat an id in
``labels`` count by their highest label; repeated rows of ``docs`` count again
in the corpus sums and are scored alike; ties in the choice of training rows go
by doc_id; a very long text is pooled whole, a slice at a time; an empty table
gives no scores; without labels of both kinds every
score is the share of label 1 (0.5 without any); other columns are ignored by
``scores`` and kept by ``keep_good``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words
from .common import arrow_map, saved, scratch_name, shuffle_partitions, small

VOCABULARY, DIM, NONZERO, WINDOW = 1 << 13, 64, 4, 2
SHAPES = 64
PIECES = 32  # the word vectors are summed in so many pieces
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 32, 60, 256, 0.01, 1e-3
MAX_LABELLED = 20_000
THRESHOLD = 0.3
SEED = 7

LETTER, DIGIT, MARK = 1, 2, 3
KIND = np.array([
    0 if words.SPACE[b] else DIGIT if 48 <= b < 58 else LETTER if b >= 128 or chr(b).isalpha() else MARK for b in range(256)],
    np.uint8)
UPPER = np.zeros(256, np.int32)
UPPER[65:91] = 1


def random_vectors(seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of each bucket's random vector."""
    rng = np.random.default_rng(seed)
    places = np.argsort(rng.random((VOCABULARY, DIM)), axis=1)[:, :NONZERO]
    return places, rng.choice([-1.0, 1.0], (VOCABULARY, NONZERO))


def items(data: np.ndarray, offsets: np.ndarray, i: int, j: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word buckets and shape buckets of the tokens of rows ``i:j``, and where
    each row's tokens start."""
    part = data[offsets[i] : offsets[j]]
    kind = KIND[part]
    rows = offsets[i : j + 1] - offsets[i]
    edge = np.zeros(len(part) + 1, bool)
    edge[rows[:-1]] = True
    edge[len(part)] = True
    change = np.ones(len(part) + 1, bool)
    change[1:-1] = kind[1:] != kind[:-1]
    cut = change | edge
    starts = np.flatnonzero(cut[:-1] & (kind > 0))
    ends = np.flatnonzero(cut[1:] & (kind > 0)) + 1
    hashes = words.hash_spans(words.ASCII_LOWER[part], starts, ends)
    text = SHAPES + (hashes % np.uint64(VOCABULARY - SHAPES)).astype(np.int64)
    upper = np.zeros(len(part) + 1, np.int64)
    np.cumsum(UPPER[part], out=upper[1:])
    n_upper, length = upper[ends] - upper[starts], ends - starts
    first_upper = UPPER[part[starts]] if len(starts) else np.zeros(0, np.int64)
    case = np.where(n_upper == 0, 0, np.where((n_upper == length) & (length > 1), 3, np.where(first_upper > 0, 1, 2)))
    size = np.minimum(np.log2(length + 1).astype(np.int64), 4) if len(starts) else length
    shape = (kind[starts].astype(np.int64) - 1) * 20 + case * 5 + size
    return text, shape, np.searchsorted(starts, rows)


def _neighbours(text: np.ndarray, shape: np.ndarray, rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(item, item beside it) pairs of one slice, both ways."""
    row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    for step in range(1, WINDOW + 1):
        same = np.flatnonzero(row[step:] == row[:-step]) if len(row) > step else np.zeros(0, np.int64)
        for a in (text, shape):
            for b in (text, shape):
                yield a[same], b[same + step]
                yield a[same + step], b[same]


def _sums(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[pa.RecordBatch]:
    """Word-vector sums of the texts of one task, as pieces."""
    pairs = np.zeros(VOCABULARY * DIM, np.float64)
    places, signs = random_vectors(seed)
    for batch in batches:
        data, offsets = words.column_bytes(batch.column(0))
        for i, j in words.slices(offsets):
            text, shape, rows = items(data, offsets, i, j)
            for a, b in _neighbours(text, shape, rows):
                for z in range(NONZERO):
                    pairs += np.bincount(a * DIM + places[b, z], signs[b, z], len(pairs))
    yield _pieces(pairs)


def _pieces(sums: np.ndarray) -> pa.RecordBatch:
    parts = [p.astype(np.float32).tobytes() for p in np.split(sums, PIECES)]
    return pa.RecordBatch.from_arrays([pa.array(range(PIECES), pa.int32()), pa.array(parts, pa.binary())], names=["piece", "sums"])


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum the pieces that meet in one task, one at a time."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for n, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            values = np.frombuffer(raw.as_buffer(), np.float32).astype(np.float64)
            total[n] = total[n] + values if n in total else values
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(total), pa.int32()), pa.array([v.astype(np.float32).tobytes() for v in total.values()], pa.binary())],
        names=["piece", "sums"])


def word_vectors(docs: DataFrame, seed: int = SEED) -> np.ndarray:
    """The word vectors of all documents: VOCABULARY x DIM, rows of length
    one (zero rows for unseen buckets).  Fixed size, whatever the corpus."""
    schema = "piece int, sums binary"
    parts = arrow_map(docs.select("text"), lambda b: _sums(b, seed), schema)
    summed = arrow_map(parts.repartition(min(PIECES, shuffle_partitions(docs.sparkSession)), "piece"), _add, schema)
    out = np.zeros((PIECES, VOCABULARY * DIM // PIECES), np.float32)
    for row in summed.collect():  # PIECES rows
        out[row.piece] = np.frombuffer(row.sums, np.float32)
    vectors = out.reshape(VOCABULARY, DIM)
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)


def pooled(data: np.ndarray, offsets: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """One feature row per document: mean word vector, mean shape vector, and
    log length, share of distinct tokens, mean token length."""
    n = len(offsets) - 1
    out = np.zeros((n, 2 * DIM + 3), np.float32)
    for i, j in words.slices(offsets, 1 << 18):
        text, shape, rows = items(data, offsets, i, j)
        counts = np.diff(rows)
        row = np.repeat(np.arange(j - i), counts)
        for k, a in enumerate((text, shape)):
            # counts per (row, item) first, so each vector is added once
            key, times = np.unique(row * VOCABULARY + a, return_counts=True)
            weight = (times / counts[key // VOCABULARY]).astype(np.float32)[:, None]
            edges = np.searchsorted(key // VOCABULARY, np.arange(j - i))
            full = np.flatnonzero(counts > 0)
            if len(full):
                sums = np.add.reduceat(vectors[key % VOCABULARY] * weight, edges[full], axis=0)
                out[i + full, k * DIM : (k + 1) * DIM] = sums
            if k == 0:
                distinct = np.bincount(key // VOCABULARY, minlength=j - i)
        chars = np.diff(offsets[i : j + 1])
        out[i:j, 2 * DIM] = np.log1p(counts)
        out[i:j, 2 * DIM + 1] = distinct / np.maximum(counts, 1) ** 0.9
        out[i:j, 2 * DIM + 2] = chars / np.maximum(counts, 1) / 8
    return out


def _features(batches: Iterator[pa.RecordBatch], vectors: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = pooled(*words.column_bytes(batch.column(1)), vectors)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([r.tobytes() for r in rows], pa.binary())], names=["doc_id", "features"])


def features(docs: DataFrame, vectors: np.ndarray) -> DataFrame:
    """(doc_id, features) per row: the pooled vector as packed float32."""
    shared = docs.sparkSession.sparkContext.broadcast(vectors)
    return arrow_map(docs.select("doc_id", "text"), lambda b: _features(b, shared.value), "doc_id long, features binary")


class Network:
    """Two dense layers with a ReLU between them, and a temperature."""

    def __init__(self, width: int, rng: np.random.Generator) -> None:
        self.mean, self.scale = np.zeros(width), np.ones(width)
        self.w1 = rng.normal(0, np.sqrt(2 / width), (width, HIDDEN))
        self.b1, self.b2 = np.zeros(HIDDEN), np.zeros(1)
        self.w2 = rng.normal(0, np.sqrt(1 / HIDDEN), (HIDDEN, 1))
        self.temperature = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.maximum(((x - self.mean) / self.scale) @ self.w1 + self.b1, 0)
        return (hidden @ self.w2 + self.b2)[:, 0]

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -60, 60)))

    def fit(self, x: np.ndarray, y: np.ndarray, rng: np.random.Generator) -> None:
        """Adam on the cross-entropy, then features scaled as in training."""
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-3
        z = (x - self.mean) / self.scale
        params = [self.w1, self.b1, self.w2, self.b2]
        first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        step = 0
        for epoch in range(EPOCHS):
            rate = RATE * (1 - epoch / EPOCHS)
            order = rng.permutation(len(z))
            for lo in range(0, len(z), BATCH):
                at = order[lo : lo + BATCH]
                hidden = z[at] @ self.w1 + self.b1
                active = np.maximum(hidden, 0)
                out = (active @ self.w2 + self.b2)[:, 0]
                error = ((1 / (1 + np.exp(-np.clip(out, -60, 60))) - y[at]) / len(at))[:, None]
                back = (error @ self.w2.T) * (hidden > 0)
                grads = [z[at].T @ back + DECAY * self.w1, back.sum(0), active.T @ error + DECAY * self.w2, error.sum(0)]
                step += 1
                for p, g, m, v in zip(params, grads, first, second, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        """The temperature with the least cross-entropy on rows not trained on."""
        logits = self.logits(x)

        def loss(t: float) -> float:
            s = np.clip(logits / t, -60, 60)
            return float(np.mean(np.logaddexp(0, s) - y * s))

        self.temperature = min(np.geomspace(0.25, 8, 121), key=loss)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(feats: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, seed: int = SEED) -> Network:
    """The network fitted on labelled rows that are not held out: a bounded
    choice of them by hash, a fifth kept for the temperature."""
    marked = labels.where("doc_id is not null and quality in (0, 1)").where(~held_out(F.col("doc_id")))
    marked = marked.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    digest = F.md5(F.concat(F.lit(f"{seed}|"), F.col("doc_id").cast("string")))
    by_hash = F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")
    # only about as many rows as are used leave the tasks
    share = max_labelled / max(1, marked.count())
    few = marked.withColumn("by_hash", by_hash).where(F.col("by_hash") < int(min(1.0, 1.05 * share) * (1 << 60)))
    chosen = few.join(feats.where("doc_id is not null").dropDuplicates(["doc_id"]), "doc_id")
    rows = sorted(chosen.select("by_hash", "doc_id", "quality", "features").collect())[:max_labelled]
    width = 2 * DIM + 3
    x = np.frombuffer(b"".join(bytes(r.features) for r in rows), np.float32).reshape(-1, width).astype(np.float64)
    y = np.array([r.quality for r in rows], np.float64)
    rng = np.random.default_rng(seed)
    net = Network(width, rng)
    if len(set(y.tolist())) < 2:
        share = np.clip(y.mean() if len(y) else 0.5, 0.001, 0.999)
        net.w2[:] = 0
        net.b2[:] = np.log(share / (1 - share))
        return net
    held = np.arange(len(y)) % 5 == 4
    net.fit(x[~held], y[~held], rng)
    if held.any():
        net.calibrate(x[held], y[held])
    return net


def _score(batches: Iterator[pa.RecordBatch], net: Network) -> Iterator[pa.RecordBatch]:
    width = 2 * DIM + 3
    for batch in batches:
        raw = batch.column(1).to_pylist()
        x = np.frombuffer(b"".join(raw), np.float32).reshape(len(raw), width).astype(np.float64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(net.probability(x), pa.float64())], names=["doc_id", "score"])


def scores(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, seed: int = SEED) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of ``docs``."""
    docs = docs.select("doc_id", "text")
    feats = saved(features(docs, word_vectors(docs, seed)))
    net = docs.sparkSession.sparkContext.broadcast(train(feats, labels, max_labelled, seed))
    scored = arrow_map(feats, lambda b: _score(b, net.value), "doc_id long, score double")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents scored below the threshold."""
    mark = scratch_name("rejected_id", docs.columns)
    bad = saved(scores(docs, labels, **options).where("predicted = 0").select(F.col("doc_id").alias(mark)).distinct())
    return docs.join(small(bad), F.col("doc_id") == F.col(mark), "left_anti")
