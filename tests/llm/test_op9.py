"""Fingerprints against true likeness; order of documents; bands."""

import hashlib
import random

import numpy as np

from logbeam.llm import op9_fingerprint as op9

from .conftest import rows_by_id
from .test_op8 import components
from .texts import edited, sentence


def check(docs, pairs):
    got = rows_by_id(op9.fingerprints(docs(pairs, extra=True)))
    ordered = sorted(pairs, key=lambda p: -p[0])
    for k, (d, t) in enumerate(ordered):
        t, n = t or "", len(t or "") // 3
        after = ordered[(k + 1) % len(ordered)][1] or ""
        new = t[: len(t) - n] + after[:n]
        assert got[d].n_chars == len(t) and got[d].edited_sha256 == hashlib.sha256(new.encode()).hexdigest(), d
    return got, ordered


def shingles(t):
    w = t.encode().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def test_next_in_descending_order_and_likeness(docs):
    rng = random.Random(1)
    pairs = [(rng.randrange(10**12), sentence(s, 30 + s % 90) + " é🙂") for s in range(300)]
    got, ordered = check(docs, pairs)
    errors = []
    for k, (d, t) in enumerate(ordered):
        after = ordered[(k + 1) % len(ordered)][1]
        new = t[: len(t) - len(t) // 3] + after[: len(t) // 3]
        a, b = shingles(t), shingles(new)
        errors.append(got[d].near_edited - len(a & b) / len(a | b))
        assert got[d].near_edited > got[d].near_next
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.1


def test_equal_texts_have_equal_fingerprints(docs):
    got, _ = check(docs, [(i, ["a b c d e f", "", None, "one"][i % 4]) for i in range(40)])
    assert len({got[i].fingerprint for i in range(0, 40, 4)}) == 1
    assert got[1].fingerprint == got[2].fingerprint != got[3].fingerprint


def test_edges(docs):
    one = op9.fingerprints(docs([(7, "abcdef")])).collect()
    assert [(r.near_next, r.n_chars) for r in one] == [(1.0, 6)]
    assert one[0].edited_sha256 == hashlib.sha256(b"abcdab").hexdigest()
    rows = op9.fingerprints(docs([(1, "aaa"), (1, "bbb"), (2, "ccc"), (None, "ddd"), (1, "aaa"), (3, "w " * 300_000)])).collect()
    shas = {(r.doc_id, r.edited_sha256) for r in rows}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert len(rows) == 6 and {(2, sha("cca")), (1, sha("aaa")), (1, sha("aab")), (1, sha("bbd")), (None, sha("ddw"))} <= shas
    assert op9.fingerprints(docs([])).collect() == []


def test_ranges_of_ids():
    from pyspark.sql import functions as F
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    cuts = [90, 70, 55, 40, 13, 2, -5]
    rows = spark.range(-20, 100).withColumn("r", op9._range_of(F.col("id"), cuts)).collect()
    assert all(r.r == sum(c > r.id for c in cuts) for r in rows)
    assert [r.r for r in spark.range(3).withColumn("r", op9._range_of(F.col("id"), [])).collect()] == [0, 0, 0]


def test_near_duplicates_are_verified(docs):
    base = sentence(8, 120)
    texts = [base, base] + [edited(base, s, 1 + s % 5) for s in range(12)] + [sentence(s) for s in range(20, 30)] + ["", "a b"]
    got = rows_by_id(op9.near_duplicates(docs(texts)))
    want = components(list(enumerate(texts)), 5, 80)
    assert {d: (r.n_shingles, r.component_id) for d, r in got.items()} == want


def test_minhash_of_long_rows():
    rng = np.random.default_rng(0)
    h = rng.integers(0, 1 << 63, 100_000, np.uint64)
    rows = np.array([0, 5, 5, 80_000, 100_000])
    got = op9.minhash(h, rows, 4)
    a, b = op9.permutations(4)
    want = [[int(((h[x:y] * a[c] + b[c]) >> np.uint64(32)).min()) if y > x else op9.EMPTY for c in range(4)] for x, y in zip(rows, rows[1:])]
    assert got.tolist() == want
