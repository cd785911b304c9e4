"""Spaced seeds: planted passages, substitutions, both join routes."""

import random

import numpy as np
import pytest

from logbeam.llm import op4_decontaminate as op4

from .texts import edited, sentence

ITEMS = [(0, sentence(900, 40)), (1, sentence(901, 25)), (2, "one two three four five six seven"), (3, None), (4, ""), (5, "a q")]


@pytest.fixture
def bench(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


def planted():
    clean = [sentence(s, 80) for s in range(20)]
    texts = list(clean)
    texts[1] = clean[1] + " " + ITEMS[0][1]
    texts[2] = ITEMS[1][1].upper().replace(" ", ", ") + ". " + clean[2]
    texts[3] = clean[3] + " " + edited(ITEMS[0][1], 1, 4) + " " + clean[4]
    texts[4] = "see: One two-three four five six SEVEN"
    texts[5] = clean[5] + " " + " ".join(ITEMS[0][1].split()[5:25])
    texts[6] = "a b c"
    texts[7] = ITEMS[0][1] + " " + ITEMS[1][1]
    return texts


WANT = {(1, 0), (2, 1), (3, 0), (4, 2), (5, 0), (7, 0), (7, 1)}


@pytest.mark.parametrize("limit", [op4.MAX_SEEDS, 0])
def test_planted_passages(docs, bench, limit):
    got = op4.contamination(docs(planted(), extra=True), bench, max_seeds=limit).collect()
    assert {(r.doc_id, r.item_id) for r in got} == WANT
    by = {(r.doc_id, r.item_id): r for r in got}
    assert by[1, 0].n_match == 40 and by[1, 0].start_word == 80
    assert by[3, 0].n_match == 36 and by[3, 0].n_aligned <= 40
    assert by[5, 0].n_match == 20


def test_routes_agree_row_by_row(docs, bench):
    df = docs(planted() * 2)
    both = [sorted(map(tuple, op4.contamination(df, bench, max_seeds=n).collect())) for n in (op4.MAX_SEEDS, 0)]
    assert both[0] == both[1]


def test_decontaminate_and_edges(docs, bench, spark):
    df = docs([(1, None), (2, ""), (None, ITEMS[0][1]), (4, ITEMS[0][1]), (5, "w " * 50_000 + ITEMS[1][1]), (6, "clean")], extra=True)
    kept = op4.decontaminate(df, bench)
    assert kept.columns == df.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 2, 6]
    assert op4.contamination(docs([]), bench).collect() == []
    none = spark.createDataFrame([], "item_id long, text string")
    assert op4.contamination(df, none).collect() == []


def test_masks_are_spaced_where_items_allow():
    for least, masks in op4.MASKS.items():
        assert all(len(m) <= least and m[0] == m[-1] == "1" for m in masks)
        assert least < 12 or all("0" in m for m in masks)
    assert {m.count("1") for m in op4.MASKS[16]} == {8} and {m.count("1") for m in op4.MASKS[12]} == {6}


def seeded(same):
    """Whether a run of equal words leaves a hit of the searched masks."""
    w = np.arange(len(same), dtype=np.uint64) * np.uint64(7919)
    other = np.where(same, w, w + np.uint64(1))
    rows = np.array([0, len(w)])
    return any((op4.seed_hashes(w, rows, m)[0] == op4.seed_hashes(other, rows, m)[0]).any() for m in op4.item_masks(len(w)))


def accepted(same):
    w = np.arange(1, len(same) + 1, dtype=np.uint64)
    return op4.verify(np.where(same, w, 0), w, 0) is not None


def test_every_accepted_short_item_has_a_seed():
    n_accepted = 0
    for n in range(5, 12):
        for bits in range(1 << n):
            same = np.array([bits >> k & 1 for k in range(n)], bool)
            if accepted(same):
                n_accepted += 1
                assert seeded(same), (n, bits)
    assert n_accepted > 100


CASES = [(12, 1), (12, 3), (13, 1), (14, 3), (15, 3), (16, 3), (16, 4), (20, 4), (20, 5), (25, 6), (30, 3), (30, 7), (40, 10), (60, 15)]


@pytest.mark.parametrize(("n", "changed"), CASES)
def test_recall_by_length_and_substitutions(n, changed):
    """Of the accepted runs, the share that holds a seed."""
    rng = random.Random(n * 100 + changed)
    hit = []
    for _ in range(400):
        same = np.ones(n, bool)
        same[rng.sample(range(n), changed)] = False
        if accepted(same):
            hit.append(seeded(same))
    assert len(hit) > 30 and np.mean(hit) >= 0.97


@pytest.mark.parametrize(("n", "changed"), [(13, 0), (14, 1), (15, 2), (16, 3), (20, 5), (25, 7)])
def test_recall_of_parts_of_a_long_item(n, changed):
    rng = random.Random(n)
    hit = []
    while len(hit) < 150:
        part = np.ones(n, bool)
        part[rng.sample(range(n), changed)] = False
        same = np.zeros(60, bool)
        at = rng.randrange(60 - n + 1)
        same[at : at + n] = part
        if accepted(same):
            hit.append(seeded(same))
    assert np.mean(hit) >= 0.96


def words_of(text):
    import re

    return re.findall(r"[^\W_]+", (text or "").lower())


def brute(pairs, items):
    """(doc, item): the best accepted run over all diagonals."""
    found = {}
    for d, text in pairs:
        doc = words_of(text)
        for i, item_text in items:
            item = words_of(item_text)
            runs = []
            for diagonal in range(-len(item) + 1, len(doc)):
                same = np.array([0 <= k + diagonal < len(doc) and doc[k + diagonal] == w for k, w in enumerate(item)])
                lo, hi = max(0, -diagonal), min(len(item), len(doc) - diagonal)
                n, start, end = op4.best_run(same[lo:hi])
                if n >= 13 or n >= (0.75 if len(item) >= 5 else 1) * len(item) > 0:
                    runs.append((-n, end - start, lo + diagonal + start))
            if runs:
                n, size, start = min(runs)
                found[d, i] = (-n, size, len(item), start)
    return found


@pytest.mark.parametrize("limit", [op4.MAX_SEEDS, 0])
def test_contamination_against_brute_force(docs, spark, limit):
    """Passages of items of many lengths, whole and in part, words changed."""
    rng = random.Random(8)
    items = [(n, sentence(700 + n, n)) for n in (1, 2, 3, 4, 5, 8, 11, 12, 14, 15, 16, 18, 25, 40, 60)]
    pairs = []
    for d in range(90):
        n, text = rng.choice(items)
        part = text.split()
        if n > 20 and rng.random() < 0.5:
            at = rng.randrange(n - 14)
            part = part[at : at + rng.randrange(10, 20)]
        changed = edited(" ".join(part), d, rng.randrange(0, max(1, len(part) // 4) + 1))
        pairs.append((d, f"{sentence(d, rng.randrange(20))} {changed} {sentence(1000 + d, rng.randrange(20))}"))
    pairs += [(90, None), (91, ""), (92, items[3][1] + " " + items[9][1] + " " + items[9][1])]
    bench = spark.createDataFrame([*items, (99, None), (98, "")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): tuple(r)[2:] for r in op4.contamination(docs(pairs), bench, max_seeds=limit).collect()}
    want = brute(pairs, items)
    assert len(want) > 40
    assert set(got) <= set(want) and len(got) >= 0.96 * len(want)
    assert all(got[k] == want[k] for k in got)


@pytest.mark.parametrize("limit", [op4.MAX_SEEDS, 0])
def test_changed_words_are_found(docs, bench, limit):
    w = ITEMS[0][1].split()
    every_sixth = " ".join("zzz" if k % 6 == 5 else x for k, x in enumerate(w))
    short = "one two 3 FOUR five six seven"
    got = op4.contamination(docs([every_sixth, short]), bench, max_seeds=limit).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(0, 0), (1, 2)}


def test_routes_agree_on_null_ids_and_repeated_rows(docs, spark):
    items = [*ITEMS[:2], (None, ITEMS[2][1]), (0, ITEMS[0][1]), (0, ITEMS[1][1]), (None, sentence(902, 20))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = docs([(None, ITEMS[0][1]), (None, ITEMS[1][1]), (1, ITEMS[2][1]), (2, ITEMS[0][1]), (2, ITEMS[0][1]), (2, "clean"), (3, items[5][1])])
    both = [sorted(map(repr, op4.contamination(df, bench, max_seeds=n).collect())) for n in (op4.MAX_SEEDS, 0)]
    assert both[0] == both[1] and len(both[0]) == 2 + 2 + 1 + 2 * 2 + 1
    kept = [sorted(repr(r.doc_id) for r in op4.decontaminate(df, bench, max_seeds=n).collect()) for n in (op4.MAX_SEEDS, 0)]
    assert kept[0] == kept[1] == ["None", "None"]
