"""Circulant MinHash: exact components, awkward groups, edge rows."""

import random

import numpy as np
import pytest

from logbeam.llm import near, op8_minhash, words

from .conftest import rows_by_id
from .texts import edited, sentence

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def shingle_set(text, k):
    w = (text or "").encode().translate(LOWER).split()
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def components(pairs, k, percent):
    sets = {d: shingle_set(t, k) for d, t in pairs}
    parent = {d: d for d in sets}

    def find(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {d: (len(sets[d]), find(d)) for d in ids}


def check(docs, pairs, k=2, percent=80):
    got = rows_by_id(op8_minhash.near_duplicates(docs(pairs, extra=True), k, percent))
    want = components(pairs, k, percent)
    assert {d: (r.n_shingles, r.component_id) for d, r in got.items()} == want
    assert all(r.kept == (d == r.component_id) for d, r in got.items())


def test_family_of_copies_chains_and_strangers(docs):
    base = sentence(1, 150)
    texts = [sentence(s) for s in range(100, 110)]
    texts += [edited(base, s, 2 + s % 14) for s in range(40)] + [base, base.upper(), base]
    chain = sentence(2, 120)
    for s in range(6):  # each link is near the next, the ends are not
        texts.append(chain)
        chain = edited(chain, 50 + s, 5)
    check(docs, list(enumerate(texts)))


def test_shared_passage_is_no_link(docs):
    passage = sentence(3, 30)
    texts = [passage + " " + sentence(s, 20 + s % 9) for s in range(40)] + [passage, passage + " tail"]
    check(docs, list(enumerate(texts)))


def test_pairs_that_no_hub_links(docs):
    # a hub that all meet, and two groups that are near among themselves only
    hub = sentence(4, 100).split()
    left, right = hub[:80] + sentence(5, 22).split(), hub[:79] + sentence(6, 24).split()
    texts = [" ".join(hub)] + [edited(" ".join(t), s, 1) for s in range(8) for t in (left, right)]
    check(docs, list(enumerate(texts)))


def test_five_words_and_threshold_edge(docs):
    # 2-word sets of 9 and 10 of which 8 are common: 8 / 11; then exactly 0.8
    a = "a b c d e f g h i j"
    texts = [a, a + " k", "a b c d e f g h i", "a b c d e f g h z", a + " k l m n", ""]
    check(docs, list(enumerate(texts)))
    check(docs, list(enumerate(texts)), 5)


def test_edge_rows(docs, spark):
    pairs = [(3, None), (1, ""), (2, " \t\n"), (7, "one"), (5, "ONE"), (6, "one two"), (8, "Été x"), (9, "été x"),
             (10, "long " * 30_000), (11, "long " * 29_000)]
    check(docs, pairs)
    df = docs([(1, "a b c"), (1, "a b c"), (2, "a b c"), (None, "a b c")])
    got = sorted((r.doc_id is None, r.doc_id, r.component_id, r.kept) for r in op8_minhash.near_duplicates(df, 2).collect())
    assert got[:3] == [(False, 1, 1, True), (False, 1, 1, True), (False, 2, 1, False)] and got[3][2] is None
    assert op8_minhash.near_duplicates(docs([]), 2).collect() == []


def test_keep_one_keeps_columns(docs):
    df = docs([sentence(1), sentence(1), sentence(2)], extra=True)
    kept = op8_minhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, 2]


def test_signature_is_the_least_of_the_shifted_order():
    rng = np.random.default_rng(0)
    hashes = rng.integers(0, 1 << 63, 70_000, np.uint64)
    rows = np.array([0, 3, 3, 40_000, 70_000])
    got = op8_minhash.circulant(hashes.copy(), rows, 7)
    whole = [op8_minhash.circulant(hashes[a:b].copy(), np.array([0, b - a]), 7)[0] for a, b in zip(rows, rows[1:])]
    assert (got == np.array(whole)).all()
    single = np.stack([op8_minhash.circulant(hashes[i : i + 1].copy(), np.array([0, 1]), 7)[0] for i in range(3)])
    assert (got[0] == single.min(axis=0)).all()
    assert (got[1] == 0xFFFFFFFF).all()


@pytest.mark.parametrize("k", [1, 2, 5])
def test_shingle_hashes_match_sets(k):
    rng = random.Random(k)
    texts = ["".join(rng.choice("ab \t\né") for _ in range(rng.randrange(40))) for _ in range(200)]
    assert [len(near.shingle_set(t, k, False)) for t in texts] == [len(shingle_set(t.replace("A", "a"), k)) for t in texts]


def test_word_hashes_do_not_depend_on_place():
    import pyarrow as pa

    data, offsets = words.column_bytes(pa.array(["a bb  ccc", None, " bb", "ccc a"]))
    h, rows = words.word_hashes(data, offsets, 0, 4)
    assert rows.tolist() == [0, 3, 3, 4, 6]
    assert h[1] == h[3] and h[2] == h[4] and h[0] == h[5] and len(set(h.tolist())) == 3


def far_copies(n, seed=0, length=148):
    """Copies of one text with 0 to 19 words changed, of a small vocabulary:
    those with few changes are linked, the many others with nothing."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(length)]
    out = []
    for _ in range(n):
        copy = list(base)
        for i in rng.sample(range(length), rng.randrange(20)):
            copy[i] = f"w{rng.randrange(300)}"
        out.append(" ".join(copy))
    return out


def test_a_large_group_of_far_copies(docs):
    check(docs, list(enumerate(far_copies(250))))


def test_pairs_of_a_group_grow_with_its_members(docs, monkeypatch):
    """A group of 400 to 1,600 copies, hundreds of them linked with nothing:
    what is compared besides the hub stays a few pairs a member."""
    met, counts = near._met, []

    def counted(under, more):
        pairs = near.saved(met(under, more))
        counts.append(pairs.count())
        return pairs

    monkeypatch.setattr(near, "_met", counted)
    for n in (400, 800, 1600):
        op8_minhash.near_duplicates(docs(far_copies(n)), 2).count()
    assert all(c <= 6 * n for c, n in zip(counts, (400, 800, 1600), strict=True)), counts
