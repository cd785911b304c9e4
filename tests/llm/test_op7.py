"""Repeated byte strings against a window-by-window brute force."""

import hashlib
import random

import numpy as np
import pytest

from logbeam.llm import bwt
from logbeam.llm import op7_suffix_dedup as op7


def brute(pairs, length=50):
    first: dict = {}
    for d, t in pairs:
        b = (t or "").encode()
        for p in range(len(b) - length + 1):
            w = b[p : p + length]
            first[w] = min(first.get(w, d), d)
    out = []
    for d, t in pairs:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if first[b[p : p + length]] < d:
                gone[p : p + length] = b"\1" * length
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def pile(seed):
    rng = random.Random(seed)
    passages = ["".join(rng.choice("abcdé \n") for _ in range(n)) for n in (40, 49, 50, 51, 80, 200, 900)]
    texts = []
    for _ in range(40):
        t = "".join(rng.choice(passages)[rng.randrange(5) :] + "".join(rng.choice("wxyz") for _ in range(rng.randrange(30))) for _ in range(rng.randrange(5)))
        texts.append(t)
    texts += ["a" * 300, "a" * 49, "a" * 50, texts[3], texts[3], "ab" * 200, ""]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    return list(zip(ids, texts))


@pytest.mark.parametrize("options", [{}, {"max_group": 0, "batch_bytes": 1}, {"max_group": 150, "batch_bytes": 1}])
def test_against_brute_force(docs, options):
    for seed in range(2):
        pairs = pile(seed)
        got = sorted(map(tuple, op7.remove_repeats(docs(pairs, extra=True), **options).collect()))
        assert got == brute(pairs), (seed, options)


def test_long_text_in_pieces(docs, monkeypatch):
    rng = random.Random(1)
    body = "".join(rng.choice("abcdefgh ") for _ in range(1 << 20))
    pairs = [(1, body[:300] + body + body[5:200]), (2, "x" + body[-70_000:] + body[1000:1400] + "q" * 60), (3, "q" * 55)]
    got = {r.doc_id: r for r in op7.remove_repeats(docs(pairs)).collect()}
    assert got[1].n_removed == 0
    assert (got[2].n_removed, got[2].n_spans) == (70_000 + 400, 1) and (got[3].n_removed, got[3].n_spans) == (55, 1)


def test_edges(docs):
    t = "same text " * 10
    rows = op7.remove_repeats(docs([(1, None), (2, ""), (3, t), (3, t), (None, t), (4, t), (None, "x" * 80)])).collect()
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_removed) for r in rows)
    assert got == [(0, 80, 0), (0, 100, 0), (1, 0, 0), (2, 0, 0), (3, 100, 0), (3, 100, 0), (4, 100, 100)]
    assert op7.remove_repeats(docs([])).collect() == []


def test_prefix_classes():
    rng = random.Random(7)
    for _ in range(150):
        strings = ["".join(rng.choice("aab\0") for _ in range(rng.randrange(25))).encode() for _ in range(rng.randrange(1, 9))]
        depth = rng.randrange(1, 9)
        lengths = np.array([len(s) for s in strings])
        first = np.concatenate([[0], np.cumsum(lengths[:-1] + 1)])
        group = bwt.prefix_classes(np.frombuffer(b"\0".join(strings) + b"\0", np.uint8), first, lengths, depth)
        seen: dict = {}
        for k, s in enumerate(strings):
            for p in range(len(s) + 1):
                c = group[first[k] + p]
                assert (c >= 0) == (p + depth <= len(s))
                if c >= 0:
                    seen.setdefault(s[p : p + depth], set()).add(int(c))
        assert all(len(c) == 1 for c in seen.values()) and len({min(c) for c in seen.values()}) == len(seen)


def test_segments_partition_the_windows():
    rng = np.random.default_rng(2)
    data = rng.integers(97, 101, 3000).astype(np.uint8)
    rows = np.array([0, 30, 30, 1200, 3000])
    first, count, m, row = op7.segments(data, rows)
    windows = [p for a, c in zip(first, count) for p in range(a, a + c)]
    want = [p for a, b in zip(rows, rows[1:]) for p in range(a, b - 49)]
    assert windows == want
    assert (row == np.searchsorted(rows, first, "right") - 1).all()


def test_a_batch_cut_small(spark, docs):
    """Documents, and occurrences of one segment, over many Arrow batches."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "3")
    try:
        pairs = pile(5) + [(1000 + i, "passage that every one of these documents holds, word for word " + str(i)) for i in range(30)]
        for options in ({}, {"max_group": 100, "batch_bytes": 1}):
            assert sorted(map(tuple, op7.remove_repeats(docs(pairs), **options).collect())) == brute(pairs)
    finally:
        spark.conf.set(key, before)


def test_ranges_of_rows_merge_in_pieces_that_fit():
    row, lo, hi = op7._merged_by_row(np.array([4, 1, 1, 4]), np.array([0, 5, 20, 9000]), np.array([9010, 30, 40, 9020]))
    assert (hi - lo <= op7.SIZE_MASK).all() and row.tolist() == [1, 4, 4, 4]
    assert (lo[0], hi[0]) == (5, 40) and lo[1] == 0 and hi[-1] == 9020 and (lo[2:] == hi[1:-1]).all()
