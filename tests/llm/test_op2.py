"""Token attribution against an independent tokenizer's offsets."""

import random

import pytest

from logbeam.llm import op2_token_counts as op2

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def other():
    t = tokenizers.Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return t


def brute(other, text, rule):
    section, k = [], 0
    for ch in text:
        section.append(k)
        k += ch == "\n"
    counts, crossing = [0] * (k + 1), [0] * (k + 1)
    for a, b in other.encode(text, add_special_tokens=False).offsets:
        own = [section[i] for i in range(a, b)]
        pick = {"first": own[0], "last": own[-1], "most": max(sorted(set(own)), key=own.count)}[rule]
        counts[pick] += 1
        if len(set(own)) > 1:
            for s in set(own):
                crossing[s] += 1
    return list(zip(counts, crossing))


def texts():
    rng = random.Random(3)
    bits = ["The cat", "\n", "\n\n", "  ", " \n ", "été", "naïve\n", "日本語", "🙂", "<|endoftext|>", "x" * 50, "1234", "\t", "!!", "\r\n"]
    return ["".join(rng.choice(bits) for _ in range(rng.randrange(30))) for _ in range(60)] + ["", "\n", "a\n", "\n" * 9, " " * 500]


@pytest.mark.parametrize("rule", op2.RULES)
def test_sections_match_brute_force(docs, other, rule):
    all_texts = texts()
    got: dict = {}
    for r in op2.token_counts(docs(all_texts, extra=True), rule=rule).collect():
        got.setdefault(r.doc_id, {})[r.section] = r
    for d, text in enumerate(all_texts):
        rows = [got[d][s] for s in sorted(got[d])]
        want = brute(other, text, rule)
        assert [(r.n_tokens, r.n_crossing) for r in rows] == want, (rule, text)
        assert rows[0].start_char == 0 and rows[-1].end_char == len(text)
        assert all(a.end_char == b.start_char for a, b in zip(rows, rows[1:]))


def test_fields_add_up_to_the_whole(spark, other):
    df = spark.createDataFrame([(1, "a title", "body one\nbody two"), (2, None, "x"), (None, None, None), (2, None, "x")], "doc_id long, title string, text string")
    rows = op2.token_counts(df, ("title", "text")).collect()
    one = [r for r in rows if r.doc_id == 1]
    assert [(r.field, r.section) for r in one] == [("title", 0), ("text", 0), ("text", 1)]
    assert sum(r.n_tokens for r in one) == len(other.encode("a title\nbody one\nbody two", add_special_tokens=False).ids)
    assert [r.start_char for r in one] == [0, 0, 9]
    assert len([r for r in rows if r.doc_id == 2]) == 4 and len([r for r in rows if r.doc_id is None]) == 2


def test_edges(docs):
    rows = op2.token_counts(docs([(1, None), (2, "long word " * 40_000)])).collect()
    assert [(r.n_tokens, r.end_char) for r in rows if r.doc_id == 1] == [(0, 0)]
    assert [r.end_char for r in rows if r.doc_id == 2] == [400_000]
    assert op2.token_counts(docs([])).collect() == []
    with pytest.raises(ValueError):
        op2.token_counts(docs([]), rule="half")
