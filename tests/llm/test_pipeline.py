"""The corpus pipeline stage by stage, against brute force on a small table."""

import re

import pytest

import corpus_pipeline as cp
from logbeam.llm import op1_quality, op5_mix
from logbeam.llm.common import table
from logbeam.session import scratch_path

from .test_op6 import brute as line_brute
from .test_op8 import components

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Rows by doc_id before the pipeline and after each stage."""
    docs = table(spark, SF, "documents")
    out, frames = [{r.doc_id: r for r in docs.collect()}], [docs]
    for name, stage in cp.STAGES:
        path = scratch_path(spark, f"t-{name}")
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        rows = docs.collect()
        out.append({r.doc_id: r for r in rows})
        assert len(out[-1]) == len(rows)
        frames.append(docs)
    return out, frames


def test_stage_columns_and_order(stages):
    assert [name for name, _ in cp.STAGES] == ["quality", "line_dedup", "near_dedup", "decontamination", "mixing"]
    _, frames = stages
    assert all(f.columns == frames[0].columns for f in frames[1:5])
    assert set(frames[0].columns) < set(frames[5].columns)


def test_quality(spark, stages):
    before, after = stages[0][0], stages[0][1]
    scores = {r.doc_id: r.predicted for r in op1_quality.scores(table(spark, SF, "documents"), table(spark, SF, "labels")).collect()}
    assert set(after) == {d for d in before if scores[d] == 1} and len(after) < len(before)


def test_lines(stages):
    before, after = stages[0][1], stages[0][2]
    want = line_brute([(d, r.text) for d, r in before.items()])
    left = {d: text for d, (text, gone) in want.items() if gone == 0 or (text or "").split()}
    assert {d: r.text for d, r in after.items()} == left
    assert all(r.n_chars == len(r.text) for r in after.values() if r.text is not None)


def test_near_duplicates(stages):
    before, after = stages[0][2], stages[0][3]
    want = components([(d, r.text) for d, r in before.items()], 2, 80)
    assert set(after) == {d for d, (_, c) in want.items() if d == c}
    assert all(after[d] == before[d] for d in after)


def test_contamination(spark, stages):
    before, after = stages[0][3], stages[0][4]

    def words(t):
        return re.findall(r"[^\W_]+", (t or "").lower())

    grams = {tuple(w[i : i + 13]) for r in table(spark, SF, "benchmark").collect() for w in [words(r.text)] for i in range(len(w) - 12)}
    bad = {d for d, r in before.items() for w in [words(r.text)] if any(tuple(w[i : i + 13]) in grams for i in range(len(w) - 12))}
    assert bad and set(after) == set(before) - bad


def test_mix(stages):
    before, after = stages[0][4], stages[0][5]
    total = sum(len((r.text or "").encode().split()) for r in before.values())
    taken = {}
    for d, r in after.items():
        assert r.text == before[d].text and 0 < r.taken <= 3 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert abs(sum(taken.values()) - total) < 0.02 * total
    for s, n in taken.items():
        target = next(r.target for r in after.values() if r.source == s)
        assert abs(n - target) < 3 * op5_mix.BLOCK_WORDS + op5_mix.BLOCK_WORDS


def test_run_gives_the_last_stage(spark, stages):
    got = {(r.doc_id, r.taken) for r in cp.run(spark, SF).collect()}
    assert got == {(d, r.taken) for d, r in stages[0][5].items()}


def test_each_stage_takes_an_empty_table(spark):
    empty = table(spark, SF, "documents").limit(0)
    for _, stage in cp.STAGES:
        assert stage(spark, empty, SF).collect() == []
