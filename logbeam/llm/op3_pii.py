"""Operator 3: personal data by weak-supervision aggregation.

All DataFrame functions.  Base spans (email, ip, card, phone) are exact by
rule and always stay.  Further candidates come from looser patterns (masked
emails, phone numbers without a plus sign, card and address numbers that fail
their rule, social security numbers, IBANs, titled names, credentials).  Three
labelers vote +1, 0 or -1 on every candidate, base spans included:

* regex: the strict form or checksum of the kind holds / fails;
* gazetteer: a known list entry (domain ending, area code, title, country
  code, credential word) is / is not in the span;
* context: the words before the span announce such data / something else.

Expectation-maximisation over the counts of vote patterns estimates how
reliable each labeler is and how often candidates of a kind are real (base
spans count as real); its posteriors train the final span classifier, a
logistic regression on kind, votes and length, which decides the candidates
that are not base spans.  The pattern table has at most
(kinds x 27 x lengths) rows, whatever the corpus; everything per document is a
column expression.

Offsets are code points, end exclusive.  A pattern's matches are located by
splitting the text at them: the pieces' lengths add up to the offsets.

Edge cases: a null text counts as empty; documents without spans have empty
lists (and the digest of the empty string); repeated rows are repeated; a null
doc_id is kept; other columns are ignored, whatever their names; a candidate
that overlaps a base span is dropped; a table without candidates trains
nothing and adds nothing; very long texts are searched whole, at a cost in
proportion to their length and matches; spans of one place are told apart by
their kind; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved

BASE = ("email", "ip", "card", "phone")

# The base patterns.  Written so that the first match at each
# place is the only one tried: runs are taken whole (possessive) and start at
# their first character or where the last match ended.
_LOCAL = r"A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    # looser kinds, in the order they are reported
    "masked_email": r"(?i)\b[a-z0-9._%+-]{1,64}+ ?[\[({<] ?at ?[\])}>] ?[a-z0-9-]{1,63}+ ?(?:[\[({<] ?dot ?[\])}>]|\.) ?[a-z]{2,}",
    "local_phone": r"(?<![0-9+(.-])(?<![0-9][ ])\(?[2-9][0-9]{2}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9-])(?![ ][0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b",
    "name": r"\b(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Monsieur|Madame|Señor|Señora)\.? \p{Lu}\p{Ll}{1,30}(?: \p{Lu}\p{Ll}{1,30})?",
    "credential": r"(?i)\b(?:token|password|passwd|secret|api[_-]?key)\b ?[=:] ?[\"']?[A-Za-z0-9_/+.-]{8,}",
}
#: A text can only match when this much of it is there (cheap to test).
NEEDS = {
    "email": "@", "phone": "\\+[0-9]", "ip": "[0-9]\\.[0-9]", "card": "[0-9][ -]?[0-9]", "masked_email": "(?i)[\\[({<] ?at ?[\\])}>]",
    "local_phone": "[0-9]{4}", "ssn": "[0-9]-[0-9]", "iban": "[A-Z]{2}[0-9]{2}",
    "name": "Mr|Ms|Dr|Prof|Herr|Frau|Mme|Monsieur|Madame|Señor", "credential": "(?i)token|passw|secret|api[_-]?key",
}
LOOSE = tuple(k for k in PATTERNS if k not in BASE)
#: Base matches that fail their rule are candidates too: negative evidence for the labelers.
FAILED = tuple(f"{k}_like" for k in ("ip", "card", "phone"))
KINDS = (*BASE, *LOOSE, *FAILED)

# The gazetteers and the words of the context labeler.
DOMAINS = r"(?i)\.(?:com|net|org|edu|gov|io|info|biz|de|fr|es|uk|it|eu|ch|at|nl|us)$"
COUNTRIES = "^(?:DE|FR|ES|GB|IT|NL|BE|AT|CH|PT|PL|SE|DK|NO|FI|IE|LU)"
ANNOUNCES = {
    "email": r"(?i)\b(?:e-?mail|mail|contact|write|reply)\b", "ip": r"(?i)\b(?:ip|host|server|address|from)\b",
    "card": r"(?i)\b(?:card|visa|mastercard|amex|credit|payment)\b", "phone": r"(?i)\b(?:phone|tel|call|mobile|fax|contact)\b",
    "ssn": r"(?i)\b(?:ssn|social|security)\b", "iban": r"(?i)\b(?:iban|account|bank)\b", "name": r"(?i)\b(?:by|from|dear|name|with)\b",
    "credential": r"(?i)\b(?:key|auth|login|secret|token)\b",
}
OTHERWISE = r"(?i)\b(?:isbn|version|page|order|item|figure|table|section|build|article|chapter|serial)\b[^.]{0,12}$"
BEFORE = 40
EM_ROUNDS, FIT_ROUNDS, RATE = 40, 400, 0.5
ACCEPT = 0.5


#: Matches of a text that are walked together.
SHARE = 128


def _with(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def located(text: Column, kind: str) -> Column:
    """array<struct<start, end, found>> of a kind's matches in order."""
    pattern = F.lit(PATTERNS[kind])
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    pieces = F.split(text, PATTERNS[kind], -1)
    pairs = F.zip_with(found, F.slice(pieces, F.lit(1), F.size(found)), lambda m, p: F.struct(m.alias("m"), F.length(p).alias("gap")))
    none = F.array().cast("array<struct<start:int,end:int,found:string>>")

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + F.length(x["m"])
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(
            start.alias("start"), end.alias("end"), x["m"].alias("found")))).alias("out"))

    def walk(share: Column, at: Column) -> Column:
        return F.aggregate(share, F.struct(at.alias("at"), none.alias("out")), step)["out"]

    def total(values: Column, of: Callable[[Column], Column]) -> Column:
        return F.aggregate(values, F.lit(0), lambda acc, x: acc + of(x))

    # each step of an aggregate copies what it has gathered, so matches are
    # walked in shares, each from the sum of the lengths before it
    last = F.greatest(F.floor((F.size(found) - 1) / SHARE), F.lit(0)).cast("int")
    shares = _with(pairs, lambda all_: F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(all_, k * SHARE + 1, SHARE)))
    walked = _with(shares, lambda parts: _with(
        F.transform(parts, lambda part: total(part, lambda x: x["gap"] + F.length(x["m"]))),
        lambda sums: F.flatten(F.transform(parts, lambda part, k: walk(part, total(F.slice(sums, 1, k), lambda x: x))))))
    return F.when(text.rlike(NEEDS[kind]), walked).otherwise(none)


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a digit string has a right Luhn check digit."""

    def value(i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        double = d * 2
        return F.when(i % 2 == 0, d).when(double > 9, double - 9).otherwise(double)

    total = F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), lambda acc, i: acc + value(i))
    return total % 10 == 0


_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"


def valid(kind: str, found: Column) -> Column:
    """The rule of a base kind beyond its pattern."""
    if kind == "ip":
        return found.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    if kind == "card":
        return luhn(_digits(found))
    if kind == "phone":
        return F.length(_digits(found)).between(8, 15)
    return F.lit(True)


def _holds(kind: str):
    return lambda s: valid(kind, s["found"])


def _fails(kind: str):
    return lambda s: ~valid(kind, s["found"])


def _is(kind: str):
    return lambda s: s["kind"] == kind


def _is_base(s: Column) -> Column:
    return s["kind"].isin(*BASE)


def _regex_vote(kind: str, found: Column) -> Column:
    """+1 / 0 / -1 of the strict form of the kind."""
    if kind in BASE:
        return F.lit(1)
    if kind in FAILED:
        return F.lit(-1)
    strict = {
        "masked_email": found.rlike(r"(?i)[\])}>] ?[a-z0-9-]+ ?(?:[\[({<] ?dot|\.)"),
        "local_phone": ~found.rlike("555[ .-]01[0-9]{2}$|^\\(?([0-9])\\1\\1"),
        "ssn": ~found.rlike("^(?:000|666|9)|-00-|-0000$"),
        "iban": F.length(F.regexp_replace(found, " ", "")).between(15, 34),
        "name": found.rlike(r"\p{Ll}{2}$"),
        "credential": found.rlike(r"(?i)[=:] ?[\"']?(?=[a-z0-9_/+.-]*[0-9])(?=[a-z0-9_/+.-]*[a-z])[a-z0-9_/+.-]{16,}"),
    }
    return F.when(strict[kind], 1).otherwise(-1)


def _gazetteer_vote(kind: str, found: Column) -> Column:
    lists = {
        "email": found.rlike(DOMAINS), "masked_email": found.rlike(r"(?i)(?:com|net|org|edu|gov|io|de|fr|es|uk)$"),
        "iban": found.rlike(COUNTRIES), "credential": found.rlike("(?i)^(?:token|password|secret|api[_-]?key)"),
        "name": found.rlike(r"^(?:Mr|Mrs|Ms|Dr|Prof)\.? "), "local_phone": found.rlike(r"^\(?[2-9][0-8][0-9]"),
    }
    return F.when(lists[kind], 1).otherwise(-1) if kind in lists else F.lit(0)


def _context_vote(kind: str, before: Column) -> Column:
    family = {"masked_email": "email", "local_phone": "phone"}.get(kind, kind.removesuffix("_like"))
    return F.when(before.rlike(OTHERWISE), -1).when(before.rlike(ANNOUNCES[family]), 1).otherwise(0)


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, spans) per row: every base span and candidate as
    struct<kind, start, end, votes, size>, base kinds first, each in order."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # through a generator, so each pattern runs once
    found = texts.select(
        "doc_id", "text", F.inline(F.array(F.struct(*(located(F.col("text"), k).alias(k) for k in PATTERNS)))))
    kept = {k: F.filter(k, _holds(k)) for k in BASE}
    failed = {f"{k}_like": F.filter(k, _fails(k)) for k in ("ip", "card", "phone")}
    base = found.select("*", F.inline(F.array(F.struct(
        *(c.alias(f"ok_{k}") for k, c in kept.items()), *(c.alias(k) for k, c in failed.items())))))
    whole = base.select("*", F.inline(F.array(F.struct(F.concat(*(f"ok_{k}" for k in BASE)).alias("ok")))))

    def described(kind: str, spans: Column) -> Column:
        def one(s: Column) -> Column:
            before = F.substring(F.col("text"), F.greatest(s["start"] - BEFORE, F.lit(0)) + 1, F.least(s["start"], F.lit(BEFORE)))
            votes = [_regex_vote(kind, s["found"]), _gazetteer_vote(kind, s["found"]), _context_vote(kind, before)]
            return F.struct(
                F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
                F.array(*(v.cast("int") for v in votes)).alias("votes"),
                F.least(F.floor((s["end"] - s["start"]) / 8), F.lit(5)).cast("int").alias("size"))

        if kind not in BASE:
            spans = F.filter(spans, lambda s: ~F.exists("ok", lambda b: (s["start"] < b["end"]) & (b["start"] < s["end"])))
        return F.transform(spans, one)

    columns = {**{k: F.col(f"ok_{k}") for k in BASE}, **{k: F.col(k) for k in (*LOOSE, *FAILED)}}
    return whole.select("doc_id", F.concat(*(described(k, columns[k]) for k in KINDS)).alias("spans"))


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-max(-40.0, min(40.0, x))))


def posteriors(patterns: list[tuple[str, tuple[int, ...], int, int]]) -> list[float]:
    """EM over (kind, votes, size, count) rows: the chance that a candidate
    of each row is real.  Base kinds are; votes are taken as independent given
    that."""
    post = [1.0 if k in BASE else _sigmoid(2 * sum(v)) for k, v, _, _ in patterns]
    for _ in range(EM_ROUNDS):
        prior: dict[str, list[float]] = {}
        vote = [[{v: 1.0 for v in (-1, 0, 1)} for _ in range(2)] for _ in range(3)]
        for (kind, votes, _, n), p in zip(patterns, post, strict=True):
            share = prior.setdefault(kind, [1.0, 1.0])
            for z, q in ((1, p), (0, 1 - p)):
                share[z] += n * q
                for j, v in enumerate(votes):
                    vote[j][z][v] += n * q
        for labeler in vote:
            for table in labeler:
                total = sum(table.values())
                for v in table:
                    table[v] /= total
        for r, (kind, votes, _, _) in enumerate(patterns):
            if kind not in BASE:
                odds = math.log(prior[kind][1] / prior[kind][0])
                odds += sum(math.log(vote[j][1][v] / vote[j][0][v]) for j, v in enumerate(votes))
                post[r] = _sigmoid(odds)
    return post


def span_classifier(patterns: list[tuple[str, tuple[int, ...], int, int]]) -> dict[tuple, float]:
    """Weights of a logistic regression on the posteriors: ("kind", kind),
    ("vote", labeler, vote), ("size", size) and ("one",)."""
    soft = posteriors(patterns)
    rows = [([("one",), ("kind", k), ("size", s), *(("vote", j, v) for j, v in enumerate(vs))], n, p)
            for (k, vs, s, n), p in zip(patterns, soft, strict=True)]
    total = sum(n for _, n, _ in rows) or 1
    weights: dict[tuple, float] = {f: 0.0 for fs, _, _ in rows for f in fs}
    for _ in range(FIT_ROUNDS):
        grad = {f: 1e-4 * w for f, w in weights.items()}
        for fs, n, p in rows:
            error = (_sigmoid(sum(weights[f] for f in fs)) - p) * n / total
            for f in fs:
                grad[f] += error
        for f, g in grad.items():
            weights[f] -= 4 * RATE * g
    return weights


def _logit(s: Column, weights: dict[tuple, float]) -> Column:
    """The classifier's logit of a span as a column."""

    def pick(value: Column, table: dict) -> Column:
        out = F.lit(0.0)
        for key, w in sorted(table.items(), key=str):
            out = F.when(value == F.lit(key), F.lit(w)).otherwise(out)
        return out

    total = F.lit(weights.get(("one",), 0.0))
    total = total + pick(s["kind"], {f[1]: w for f, w in weights.items() if f[0] == "kind"})
    total = total + pick(s["size"], {f[1]: w for f, w in weights.items() if f[0] == "size"})
    for j in range(3):
        total = total + pick(F.get(s["votes"], F.lit(j)), {f[2]: w for f, w in weights.items() if f[0] == "vote" and f[1] == j})
    return total


def personal_data(docs: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """(doc_id, base, spans) per row: the base spans and all spans, each an
    array<struct<kind, start, end>> by kind (base kinds first), then start."""
    found = saved(candidates(docs))
    each = found.select(F.explode("spans").alias("s")).select("s.kind", "s.votes", "s.size")
    table = each.groupBy("kind", "votes", "size").agg(F.count(F.lit(1)).alias("n")).collect()  # bounded, see above
    patterns = sorted((r.kind, tuple(r.votes), r.size, r.n) for r in table)
    weights = span_classifier(patterns)
    logit = math.log(accept / (1 - accept))

    def bare(spans: Column) -> Column:
        return F.transform(spans, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))

    return found.select(
        "doc_id", bare(F.filter("spans", _is_base)).alias("base"),
        bare(F.filter("spans", lambda s: _is_base(s) | (_logit(s, weights) >= logit))).alias("spans"))


def written(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame) -> DataFrame:
    """Counts, digest of the base spans, and all spans as text."""
    counts = [F.size(F.filter("base", _is(k))).cast("long").alias(f"n_{k}") for k in BASE]
    return found.select("doc_id", *counts, F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))
