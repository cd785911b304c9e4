"""Merkle manifest against a plain recursive one."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from logbeam.llm import op12_merkle as op12

from .conftest import DOCS, EXTRA

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def h(*parts):
    return hashlib.sha256("".join(parts).encode("utf-8")).hexdigest()


def leaf(row):
    doc_id, text, lang, source, n_chars = row
    values = ["-" if v is None else f"{len(str(v).encode('utf-8'))}:{v}" for v in (doc_id, source, lang, n_chars, text)]
    return h(*values)


def tree(nodes):
    """Top of the nodes, and each node's [(left, right), ...] up to it."""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for i, a in enumerate(at):
            lo = a - a % 16
            run = level[lo : lo + 16]
            paths[i].append(("".join(run[: a - lo]), "".join(run[a - lo + 1 :])))
        level = [h(*level[i : i + 16]) for i in range(0, len(level), 16)]
        at = [a // 16 for a in at]
    return (level[0] if level else None), paths


def brute(rows):
    by_source = {}
    for r in rows:
        by_source.setdefault(r[3], []).append(r)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode("utf-8")))
    tops, held = [], []
    for s in order:
        own = sorted(by_source[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        top, paths = tree([leaf(r) for r in own])
        tops.append(top)
        held.append(list(zip(own, paths, strict=True)))
    root, source_paths = tree(tops)
    out = []
    for top, above, members in zip(tops, source_paths, held, strict=True):
        for row, path in members:
            path = path + above
            node = leaf(row)
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[1] is not None:
                node = leaf((row[0], row[1].translate(LOWER), *row[2:]))
            for left, right in path:
                node = h(left, node, right)
            proof = h("".join(left + right for left, right in path))
            out.append((row[0], leaf(row), top, root, proof, node, node == root))
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, *r[1:]))


def manifest(spark, rows, schema=DOCS):
    df = spark.createDataFrame(rows, schema)
    found = op12.verify(df, op12.every_fifth(F.col("doc_id")), {"text": op12.lower_ascii(F.col("text"))})
    return sorted((tuple(r) for r in found.collect()), key=lambda r: (r[0] is not None, r[0] or 0, *r[1:]))


def documents(sizes, seed=1):
    """(doc_id, text, lang, source, n_chars) rows of sources of the given sizes."""
    rng = random.Random(seed)
    rows = []
    for s, n in enumerate(sizes):
        for _ in range(n):
            text = rng.choice([None, "", "Ärger A", "lower", "Été ABC", "x" * rng.randrange(50)])
            rows.append([None, text, rng.choice(["en", None]), f"s{s}" if s else None, rng.choice([None, 5])])
    ids = list(range(len(rows)))
    rng.shuffle(ids)
    return [(i, *r[1:]) for i, r in zip(ids, rows, strict=True)]


@pytest.mark.parametrize("sizes", [[1], [16, 17, 1, 15, 257, 0, 2], [1] * 40])
def test_against_brute_force(spark, sizes):
    rows = documents(sizes)
    assert manifest(spark, rows) == brute(rows)


def test_tampering_is_found(spark):
    rows = documents([200, 60])
    found = {r[0]: r[-1] for r in manifest(spark, rows)}
    changed = {r[0] for r in rows if r[1] is not None and r[1] != r[1].translate(LOWER) and zlib.crc32(str(r[0]).encode()) % 5 == 0}
    assert changed and {d for d, ok in found.items() if not ok} == changed


def test_null_ids_and_repeated_rows(spark):
    rows = [(None, "a", "en", "s", 1)] * 3 + [(4, "B", None, "s", None)] * 20 + [(None, None, None, None, None)]
    assert manifest(spark, rows) == brute(rows)


def test_empty_table_and_clashing_columns(spark):
    assert manifest(spark, []) == []
    rows = documents([20])
    wide = [(*r, *("x",) * 7, "x", 1, 2) for r in rows]
    assert manifest(spark, wide, DOCS + ", " + EXTRA + ", leaf string, g int, idx int") == brute(rows)


def test_long_text_and_awkward_sources(spark):
    rows = [(i, "Ab" * 500_000 if i == 3 else "t", "en", s, 1) for i, s in enumerate(["b", "a", "é", "Z", "", "🙂", None, "a"])]
    assert manifest(spark, rows) == brute(rows)
