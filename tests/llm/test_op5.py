"""Sainte-Lague mixing against a plain highest-quotient loop."""

import heapq
import random
from fractions import Fraction

from logbeam.llm import op5_mix


def water_fill(sizes, weights=(1, 2, 3), most=3):
    order = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total = sum(sizes.values())
    capped: set = set()
    while True:
        left = Fraction(total - sum(most * sizes[s] for s in capped))
        free = [s for s in order if s not in capped]
        target = {s: left * w[s] / sum(w[f] for f in free) for s in free}
        over = {s for s in free if target[s] > most * sizes[s]}
        if not over:
            return {**{s: Fraction(most * sizes[s]) for s in capped}, **target}
        capped |= over


def highest_quotients(votes, seats):
    heap = [(-Fraction(v), k) for k, v in sorted(votes.items()) if v]
    heapq.heapify(heap)
    out = dict.fromkeys(votes, 0)
    for _ in range(seats):
        _, k = heapq.heappop(heap)
        out[k] += 1
        heapq.heappush(heap, (-Fraction(votes[k]) / (2 * out[k] + 1), k))
    return out


def make(spark, seed, n=300):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = rng.choice([None, "", "a", "b", "Z", "é", "big", "big", "big"])
        rows.append((i, " ".join(["w"] * rng.randrange(0, 120)), source))
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_targets_and_totals(spark):
    for seed in (1, 2):
        df = make(spark, seed)
        rows = op5_mix.mix(df, block_words=8, shard_words=500).collect()
        assert len(rows) == 300
        sizes: dict = {}
        for r in rows:
            sizes[r.source] = sizes.get(r.source, 0) + r.size
        want = water_fill(sizes)
        taken = dict.fromkeys(sizes, 0)
        for r in rows:
            assert abs(r.target - float(want[r.source])) < 1e-6 and r.source_size == sizes[r.source]
            assert r.taken <= 3 * r.size and r.taken == sum((b.end - b.start) * b.copies for b in r.blocks)
            assert all(0 <= b.start < b.end <= r.size for b in r.blocks)
            taken[r.source] += r.taken
        for s in sizes:  # a block more or less, and the short last block of each shard
            shards = -(-sizes[s] // 500) or 1
            assert abs(taken[s] - float(want[s])) <= 8 * (1 + 3 * shards)


def test_apportionment_is_sainte_lague(spark):
    rng = random.Random(5)
    groups, rows = {}, []
    for g in range(25):
        n, seats = rng.randrange(1, 9), rng.randrange(0, 60)
        votes = {f"p{i}": rng.choice([0, 1, rng.randrange(1, 50), rng.randrange(1, 10_000)]) for i in range(n)}
        if not any(votes.values()):
            seats = 0
        groups[g] = highest_quotients(votes, seats)
        rows += [(g, p, float(v), seats, 10**6) for p, v in votes.items()]
    df = spark.createDataFrame(rows, "g long, p string, vote double, seats long, most long")
    got = {(r.g, r.p): r.quota for r in op5_mix.apportion(df, ["g"], "p", "seats", "most").collect()}
    assert got == {(g, p): q for g, out in groups.items() for p, q in out.items()}


def test_reruns_agree_and_order_does_not_matter(spark):
    df = make(spark, 3)
    runs = [sorted((r.doc_id, r.taken) for r in op5_mix.mix(d, block_words=8, shard_words=500).collect()) for d in (df, df.orderBy("text"))]
    assert runs[0] == runs[1]


def test_edges(spark):
    schema = "doc_id long, text string, source string, taken string, weight string, n_chars long"
    df = spark.createDataFrame(
        [(1, None, "a", "x", "y", 1), (None, "b c", None, "x", "y", 1), (3, "", "e", "x", "y", 0), (4, "w " * 40_000, "a", "x", "y", 2),
         (5, "q r", "a", "x", "y", 1), (5, "q r", "a", "x", "y", 1)], schema)
    rows = op5_mix.mix(df).collect()
    assert len(rows) == 6 and sum(r.size for r in rows) == 40_006
    assert all(r.taken == 0 for r in rows if r.size == 0)
    out = op5_mix.mixed_documents(df)
    assert set(out.columns) == {*df.columns, "size", "source_size", "target", "blocks"}
    assert all(r.taken > 0 for r in out.collect())
    empty = spark.createDataFrame([], schema)
    assert op5_mix.mix(empty).collect() == [] and op5_mix.mixed_documents(empty).collect() == []
