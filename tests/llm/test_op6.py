"""Line dedup against brute force over all pairs of lines."""

import random

from logbeam.llm import op6_line_dedup as op6

from .conftest import rows_by_id
from .texts import words


def distance_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    s, t = sorted((a, b), key=len)
    return any(s == t[:i] + t[i + 1 :] for i in range(len(t)))


def brute(pairs):
    lines = [(d, p, line.encode().split()) for d, t in sorted(pairs, key=lambda x: x[0]) for p, line in enumerate((t or "").split("\n"))]
    gone: dict = {}
    for i, (d, p, w) in enumerate(lines):
        if not w:
            continue
        for e, q, v in lines[:i]:
            if (e, q) != (d, p) and v and (v == w or (min(len(v), len(w)) >= op6.MIN_WORDS and distance_one(v, w))):
                gone.setdefault(d, set()).add(p)
                break
    return {d: ("\n".join(x for p, x in enumerate((t or "").split("\n")) if p not in gone.get(d, ())), len(gone.get(d, ()))) for d, t in pairs}


def family(seed):
    rng = random.Random(seed)
    bases = [words(rng, n, 60) for n in (4, 9, 10, 10, 11, 12, 20, 21, 30)]
    out = []
    for _ in range(14):
        lines = []
        for _ in range(rng.randrange(1, 7)):
            w = list(rng.choice(bases))
            kind = rng.randrange(6)
            if kind == 1:
                w[rng.randrange(len(w))] = "z"
            elif kind == 2:
                del w[rng.randrange(len(w))]
            elif kind == 3:
                w.insert(rng.randrange(len(w) + 1), rng.choice(w))
            elif kind == 4:
                i, j = rng.randrange(len(w)), rng.randrange(len(w))
                w.insert(j, w.pop(i))
            elif kind == 5:
                lines.append("")
            lines.append(rng.choice([" ", "  ", "\t"]).join(w))
        out.append("\n".join(lines))
    return out


def test_against_brute_force(docs):
    for seed in range(3):
        pairs = list(enumerate(family(seed)))
        got = rows_by_id(op6.line_report(docs(pairs, extra=True)))
        assert {d: (r.text, r.n_removed) for d, r in got.items()} == brute(pairs), seed


def test_hot_line_and_hot_variant(docs):
    rng = random.Random(9)
    head, tail = " ".join(words(rng, 8, 500)), " ".join(words(rng, 6, 500))
    texts = [f"hot line of all\n{head} {i} {tail}" for i in range(400)]
    got = rows_by_id(op6.line_report(docs(texts)))
    assert got[0].text == texts[0] and got[0].n_removed == 0
    assert all(got[i].text == "" and got[i].n_removed == 2 for i in range(1, 400))


def test_edges(docs):
    line = " ".join(f"w{i}" for i in range(12))
    long = " ".join(f"v{i}" for i in range(20_000))
    df = docs([(5, None), (6, ""), (7, " \n\n"), (8, line + "\n"), (9, line), (None, line), (10, long), (11, long + " more"), (9, line)], extra=True)
    rows = op6.line_report(df).collect()
    got = {r.doc_id: r for r in rows}
    assert (got[5].text, got[5].n_lines) == (None, 0) and got[6].text == "" and got[7].text == " \n\n" and got[8].text == line + "\n"
    assert [r.text for r in rows if r.doc_id == 9] == ["", ""] and got[None].text == line
    assert got[10].text == long and got[11].text == ""
    out = op6.dedup_lines(df)
    assert out.columns == df.columns
    assert sorted((r.doc_id or 0) for r in out.collect()) == [0, 5, 6, 7, 8, 10]
    assert op6.dedup_lines(docs([])).collect() == [] and op6.line_report(docs([])).collect() == []


def test_dedup_updates_n_chars(docs):
    out = rows_by_id(op6.dedup_lines(docs(["one line\nother", "one line\nété"])))
    assert (out[1].text, out[1].n_chars) == ("été", 3) and out[0].n_chars == 14


def test_plan_is_native(docs):
    plan = op6.line_report(docs(["a b", "a b"]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
