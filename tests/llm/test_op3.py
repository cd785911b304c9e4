"""Personal data: base spans against the contract's patterns, labelers, EM."""

import hashlib
import random
import re

from logbeam.llm import op3_pii as op3

from .conftest import rows_by_id

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(s):
    d = [int(c) for c in reversed(s) if c.isdigit()]
    return sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(d)) % 10 == 0


def digits(s):
    return sum(c.isdigit() and c.isascii() for c in s)


RULES = [
    ("email", EMAIL, lambda s: True), ("ip", IP, lambda s: all(int(x) <= 255 for x in s.split("."))),
    ("card", CARD, lambda s: 16 <= digits(s) <= 19 and luhn(s)), ("phone", PHONE, lambda s: 8 <= digits(s) <= 15),
]


def base(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p, rule in RULES for m in p.finditer(text or "") if rule(m.group())]


def card(rng, n=16):
    body = [rng.randrange(10) for _ in range(n - 1)]
    return next(s for c in range(10) if luhn(s := "".join(map(str, [*body, c]))))


def messy(rng):
    bits = ["a@b.co", "x.y+z@w-1.org", "@", ".", "..", "-", " ", "  ", "+", "+1 (017) 555-7713", "1.2.3.4", "256.1.1.1", "001.02.3.255",
            "9" * 5, "12", "é", "🙂", "_", "%", "(", ")", "a@b@c.de", "a@b.c_d@e.f", "\n", " ", "0", "٣", "a" * 40, "1.2.3.4.5.6.7.8.9"]
    out = [rng.choice(bits) if rng.random() < 0.85 else re.sub(r"(....)", lambda m: m[1] + rng.choice(["", " ", "-"]), card(rng, rng.randrange(14, 21))) for _ in range(rng.randrange(25))]
    return "".join(out)


def test_base_spans_on_adversarial_text(docs):
    rng = random.Random(4)
    texts = [messy(rng) for _ in range(600)]
    got = rows_by_id(op3.digest(op3.personal_data(docs(texts, extra=True))))
    for d, text in enumerate(texts):
        want = base(text)
        r = got[d]
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), (text, want, r.spans)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(w.startswith(k + ":") for w in want) for k in op3.BASE]
        spans = [s for s in r.spans.split(",") if s]
        assert [s for s in spans if s.split(":")[0] in op3.BASE] == want


def test_method_adds_spans_and_leaves_clean_text(docs):
    texts = [f'some words token = "{hashlib.md5(b"%d" % i).hexdigest()}" and more' for i in range(1, 30)]
    texts += ["plain words without anything"] * 40 + [f"order {chr(97 + i)} 4111111111111112 x" for i in range(10)]
    texts += [f"write to a{i}@mail.example.com or call +1 (555) 555-01{i:02d}" for i in range(10, 30)]
    got = rows_by_id(op3.digest(op3.personal_data(docs(texts))))
    assert all("credential" in got[i].spans for i in range(29))
    assert all(got[i].spans == "" for i in range(29, 79))
    assert all("email" in got[i].spans and "phone" in got[i].spans for i in range(79, 99))
    s = got[0].spans.split(":")
    assert texts[0][int(s[1]) : int(s[2])].startswith('token = "')


def test_em_learns_reliabilities():
    rng = random.Random(0)
    counts: dict = {}
    real = []
    for _ in range(6000):
        z = rng.random() < 0.3
        votes = tuple((1 if (rng.random() < p) == z else -1) for p in (0.95, 0.8, 0.55))
        counts[votes] = counts.get(votes, 0) + 1
        real.append((votes, z))
    patterns = [("email", (1, 1, 1), 1, 30)] + [("ssn", v, 1, n) for v, n in sorted(counts.items())]
    post = dict(zip([p[1] for p in patterns[1:]], op3.posteriors(patterns)[1:]))
    right = sum((post[v] > 0.5) == z for v, z in real) / len(real)
    majority = sum((sum(v) > 0) == z for v, z in real) / len(real)
    assert right > 0.93 and right > majority + 0.02
    weights = op3.span_classifier(patterns)
    assert weights[("vote", 0, 1)] > weights[("vote", 0, -1)]


def test_edges(docs):
    long = "x " * 30_000 + "a@b.co" + " 1.2.3.4" * 2000
    df = docs([(1, None), (2, ""), (None, "a@b.co"), (4, long), (4, long), (5, "a.b" * 30_000 + "@" + "c." * 5000 + "d")], extra=True)
    rows = op3.digest(op3.personal_data(df)).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert all(r.base_sha256 == empty and r.spans == "" for r in rows if r.doc_id in (1, 2))
    assert [r.n_email for r in rows if r.doc_id is None] == [1]
    assert [(r.n_email, r.n_ip) for r in rows if r.doc_id == 4] == [(1, 2000)] * 2
    assert [r.n_email for r in rows if r.doc_id == 5] == [1]
    assert op3.personal_data(docs([])).collect() == []


def test_plan_is_native(docs):
    plan = op3.candidates(docs(["a@b.co"]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_many_matches_of_one_text(spark):
    """Matches cost a share of their number each, not all before them."""
    import time

    n = 20_000
    df = spark.createDataFrame([(" ".join(f"m{i}@x.org" for i in range(n)),)], "text string")
    t0 = time.time()
    (row,) = df.select(op3.located(df.text, "email").alias("s")).collect()
    assert len(row.s) == n and (row.s[0].start, row.s[0].found) == (0, "m0@x.org")
    ends = [s.end for s in row.s]
    assert all(s.start == e + 1 for s, e in zip(row.s[1:], ends)) and row.s[n - 1].found == f"m{n - 1}@x.org"
    assert time.time() - t0 < 10
