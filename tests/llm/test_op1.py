"""Quality classifier: held-out accuracy, calibration, edge rows."""

import numpy as np
import pytest

from logbeam.llm import op1_quality as op1
from logbeam.llm import queries
from logbeam.llm.common import table

SF = "/root/testdata/sf0.01"


def crc_held(doc_id):
    import zlib

    return zlib.crc32(str(doc_id).encode()) % 5 == 0


@pytest.fixture(scope="module")
def scored(spark):
    return {r.doc_id: r for r in queries.op1_quality_classifier(spark, SF).collect()}


def test_held_out_accuracy(spark, scored):
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    held = [(labels[d], r.score) for d, r in scored.items() if d in labels and r.held_out]
    good, bad = [s for q, s in held if q == 1], [s for q, s in held if q == 0]
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert len(bad) >= 5 and auc > 0.95
    assert np.mean([(s >= 0.3) == (q == 1) for q, s in held]) > 0.93
    # calibrated: the mean score is near the share of label 1
    assert abs(np.mean([s for _, s in held]) - np.mean([q for q, _ in held])) < 0.08


def test_contract_columns(spark, scored):
    assert len(scored) == 1000
    for d, r in scored.items():
        assert r.held_out == crc_held(d) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)


def test_held_out_labels_do_not_train(spark):
    docs = table(spark, SF, "documents").where("doc_id < 120")
    labels = table(spark, SF, "labels")
    flipped = labels.select("doc_id", op1.F.when(op1.held_out(op1.F.col("doc_id")), 1 - labels.quality).otherwise(labels.quality).alias("quality"))
    a, b = (sorted(map(tuple, op1.scores(docs, x).collect())) for x in (labels, flipped))
    assert a == b


def test_edges(spark, docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (3, None), (None, 1), (4, 7)], "doc_id long, quality int")
    df = docs([(1, "fine words here"), (2, "BAD!! $$$"), (3, None), (4, ""), (None, "x"), (4, ""), (9, "ab " * 60_000)], extra=True)
    rows = op1.scores(df, labels).collect()
    assert len(rows) == 7 and all(0 <= r.score <= 1 for r in rows)
    assert [r.held_out for r in rows if r.doc_id is None] == [False]
    assert len({r.score for r in rows if r.doc_id in (3, 4)}) == 1  # null and empty alike
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in op1.scores(df, none).collect()} == {0.5}
    assert op1.scores(docs([]), labels).collect() == []
    kept = op1.keep_good(df, none)
    assert kept.columns == df.columns and kept.count() == 7


def test_random_vectors_and_tokens():
    from logbeam.llm import words
    import pyarrow as pa

    places, signs = op1.random_vectors()
    assert places.shape == (op1.VOCABULARY, op1.NONZERO) and set(np.unique(signs)) == {-1.0, 1.0}
    assert all(len(set(p)) == op1.NONZERO for p in places[:50])
    text, shape, rows = op1.items(*words.column_bytes(pa.array(["Abc abc!! 12", None, "ABC"])), 0, 3)
    assert rows.tolist() == [0, 4, 4, 5]
    assert text[0] == text[1] == text[4] and len(set(shape[[0, 1, 4]])) == 3


def brute_vectors(texts):
    """Word vectors and pooled features token by token."""
    import pyarrow as pa

    from logbeam.llm import words

    places, signs = op1.random_vectors()
    index = np.zeros((op1.VOCABULARY, op1.DIM))
    for b in range(op1.VOCABULARY):
        index[b, places[b]] = signs[b]
    tokens = []
    for t in texts:
        text, shape, _ = op1.items(*words.column_bytes(pa.array([t], pa.string())), 0, 1)
        tokens.append(list(zip(text.tolist(), shape.tolist())))
    sums = np.zeros((op1.VOCABULARY, op1.DIM))
    for row in tokens:
        for p, own in enumerate(row):
            for q in range(max(0, p - op1.WINDOW), min(len(row), p + op1.WINDOW + 1)):
                if p != q:
                    for a in own:
                        for b in row[q]:
                            sums[a] += index[b]
    vectors = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
    rows = []
    for t, row in zip(texts, tokens):
        n = max(1, len(row))
        means = [sum((vectors[x[k]] for x in row), np.zeros(op1.DIM)) / n for k in (0, 1)]
        plain = [np.log1p(len(row)), len({x[0] for x in row}) / n**0.9, len((t or "").encode()) / n / 8]
        rows.append(np.concatenate([*means, plain]))
    return vectors, np.array(rows)


def test_vectors_and_pooling_against_brute_force(docs):
    import pyarrow as pa

    from logbeam.llm import words

    texts = ["Fine words, here and THERE!", None, "", "a", "été 12 12 12 -- x", "Fine fine FINE fIne words " * 9, "\n\t "]
    vectors, rows = brute_vectors(texts)
    got = op1.word_vectors(docs(texts).repartition(3))
    assert np.allclose(got, vectors, atol=1e-5)
    assert np.allclose(op1.pooled(*words.column_bytes(pa.array(texts, pa.string())), vectors.astype(np.float32)), rows, atol=1e-4)
