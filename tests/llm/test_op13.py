"""Cross-tokenizer alignment against a plain count of overlapping tokens."""

import hashlib
import json
import random
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

from logbeam.llm import op13_alignment as op13

from .conftest import DOCS, EXTRA

sentencepiece = pytest.importorskip("sentencepiece")
tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def pair():
    a = tokenizers.Tokenizer.from_file(op13.A_FILE)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=op13.B_FILE)


def tokens(pair, text):
    """(id, bytes) of both sides, or none: A's bytes are cut by the
    tokenizer's own character offsets where a token is whole characters."""
    a, b = pair
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(c): c for c in plain}
    byte_of |= {chr(256 + k): c for k, c in enumerate(x for x in range(256) if x not in plain)}
    left = [(i, bytes(byte_of[c] for c in a.id_to_token(i))) for i in a.encode(" " + (text or ""), add_special_tokens=False).ids]
    right = []
    for i in b.encode(text or ""):
        piece = b.id_to_piece(i)
        right.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
    whole = (" " + (text or "")).encode()
    same = all(b"".join(t for _, t in side) == whole for side in (left, right))
    return (left, right) if text and same else ([], [])


def spans(side):
    at, out = 0, []
    for i, data in side:
        out.append((i, at, at + len(data)))
        at += len(data)
    return out


def brute(pair, rows):
    docs, total = [], Counter()
    for doc_id, text in rows:
        left, right = (spans(s) for s in tokens(pair, text))
        links = [(x, y) for x, a0, a1 in left for y, b0, b1 in right if a0 < b1 and b0 < a1]
        total.update(links)
        common = sorted({e for *_, e in left} & {e for *_, e in right})
        cut = lambda side, lo, hi: ",".join(str(i) for i, s, e in side if lo <= s and e <= hi)
        groups = ";".join(f"{cut(left, lo, hi)}|{cut(right, lo, hi)}" for lo, hi in zip([0, *common], common))
        docs.append((doc_id, len(left), len(right), len(common), links, hashlib.sha256(groups.encode()).hexdigest() if left else ""))
    best = {}
    for (_, y), n in total.items():
        best[y] = max(best.get(y, 0), n)
    return sorted(
        (d, a, b, g, len(links), sum(total[x] == best[x[1]] for x in links), sum(total[x] for x in links), s)
        for d, a, b, g, links, s in docs)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def aligned(df):
    return sorted(tuple(r) for r in op13.alignment(df).select(COLUMNS).collect())


def texts():
    rng = random.Random(11)
    bits = ["The cat ", "sat", "\n", "  ", " ▁x", "été ", "naïve", "日本語", "🙂", "<|endoftext|>", "<s>", "</s>", "<unk>", "<0x41>", "\t", "1234", "!!", "\r\n",
            "x" * 40, " ", "ﬁ", "é", "\0"]
    return ["".join(rng.choice(bits) for _ in range(rng.randrange(25))) for _ in range(60)] + [None, "", " ", "\n", "a", " a", "a ", "the " * 300]


def test_against_brute_force(pair, docs):
    rows = list(enumerate(texts()))
    assert aligned(docs(rows)) == brute(pair, rows)


def test_chunks_of_any_size(pair, docs, monkeypatch):
    """Counts cross chunk borders; both routes of the pairs' counts agree."""
    rows = list(enumerate(texts()))
    df = docs(rows).repartition(3)
    whole = aligned(df)
    monkeypatch.setattr(op13, "few", lambda df: False)
    assert aligned(df) == whole == brute(pair, rows)


def test_repeated_rows_clashing_columns_and_empty(pair, docs):
    rows = [(3, "The cat sat")] * 4 + [(5, "cat")]
    assert aligned(docs(rows, extra=True)) == brute(pair, rows)
    assert aligned(docs([])) == []


def test_null_id_and_extra_columns(spark, pair):
    df = spark.createDataFrame([(None, "a cat", "en", None, 1) + ("x",) * 7 + (1, b"")], DOCS + ", " + EXTRA + ", chunk long, bits binary")
    assert [r.doc_id for r in op13.alignment(df).collect()] == [None]


def test_a_long_text(pair, docs):
    rng = random.Random(2)
    text = " ".join("".join(rng.choice("abcdeé🙂") for _ in range(rng.randrange(1, 9))) for _ in range(60_000))
    (got,) = aligned(docs([(1, text)]))
    left, right = tokens(pair, text)
    assert got[1:3] == (len(left), len(right)) and got[4] == got[1] + got[2] - got[3]


def test_joined_bytes_of_the_whole_vocabulary():
    enc = op13.encoders(Path(op13.A_FILE).read_bytes(), Path(op13.B_FILE).read_bytes())
    spec = json.loads(Path(op13.A_FILE).read_text())
    assert len(enc.a_bytes.lengths) == len(spec["model"]["vocab"]) + len(spec["added_tokens"])
    assert enc.a_bytes.lengths.min() > 0 and enc.b_bytes.lengths[3:].min() > 0
    assert enc.b_bytes.joined(np.array([3 + 0x41, 259])).tobytes() == b"A  "


def test_bitmaps_round_trip():
    rng = np.random.default_rng(4)
    sets = [np.sort(rng.choice(op13.CHUNK_DOCS, n, replace=False)) for n in (1, 255, 256, 257, 2000, op13.CHUNK_DOCS, 3)]
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    bits = op13.bitmaps(np.concatenate(sets), starts).to_pylist()
    assert [op13.slots_of(b).tolist() for b in bits] == [s.tolist() for s in sets]


def test_planes_count_and_merge(spark):
    """Popcounts of planes give documents and links; OR unites loads."""
    rng = np.random.default_rng(6)
    links = [np.sort(rng.integers(0, 6, rng.integers(0, 60))).astype(np.int64) for _ in range(700)]
    pairs, planes, bits = op13.inverted(links)
    rows = [(0, int(p), int(k), b) for p, k, b in zip(pairs, planes, bits.to_pylist(), strict=True)]
    df = spark.createDataFrame(rows, "chunk long, pair long, plane int, bits binary")
    got = {r.pair: (r.n_docs, r.n_links) for r in op13.pair_counts(df).collect()}
    assert got == {p: (sum(p in x for x in links), sum(int((x == p).sum()) for x in links)) for p in range(6)}
    halves = [op13.inverted([x if (i < 350) == first else x[:0] for i, x in enumerate(links)]) for first in (True, False)]
    both = [(0, int(p), int(k), b) for h in halves for p, k, b in zip(h[0], h[1], h[2].to_pylist(), strict=True)]
    united = op13.merged(spark.createDataFrame(both, "chunk long, pair long, plane int, bits binary"))
    assert sorted(tuple(r) for r in united.select("pair", "plane", "bits").collect()) == sorted((p, k, b) for _, p, k, b in rows)
