"""Operator 2: token counts by offset-mapped attribution.

A document is its fields one after the other, each but the last followed by a
line break; it is encoded once, whole.  The byte lengths of the tokens give
their character spans, and these are joined as intervals to the sections: the
lines of each field, a line break belonging to the line it ends.  A token that
lies in one section counts there.  A token that crosses a boundary is
allocated by ``rule``:

* ``"most"``: to the section that holds most of its characters, the earlier
  one of equals;
* ``"first"`` / ``"last"``: to the section of its first / last character.

A character whose bytes are spread over several tokens belongs to each of
them.  Every token is allocated to one section, so a document's sections add
up to its tokens.

The vocabulary is a rank file of a public byte-level BPE; its path is a
parameter, it is read by the driver and broadcast (under a megabyte).

Edge cases: a null field counts as empty; an empty document has one section
per field with no tokens; the texts of special tokens are ordinary text;
repeated rows are repeated in the result; a null doc_id is kept; a very long
text is encoded whole; of sections that hold as much of a token the earlier one
has it; an empty table gives no rows; other columns are ignored, whatever their
names.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import arrow_map

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the split pattern that belongs to that vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
RULES = ("most", "first", "last")
SCHEMA = "doc_id long, field string, section int, start_char long, end_char long, n_tokens long, n_crossing long"

_encoders: dict = {}


def encoder(ranks_file: bytes, pattern: str = PATTERN):
    """The encoder of a rank file and the byte length of each token, built
    once per process."""
    import tiktoken

    key = (hashlib.md5(ranks_file).digest(), pattern)
    if key not in _encoders:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks_file.splitlines())}
        lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            lengths[rank] = len(token)
        _encoders[key] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), lengths
    return _encoders[key]


def token_spans(tokens: np.ndarray, lengths: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-last character of each token of the UTF-8 bytes."""
    ends = np.cumsum(lengths[tokens])
    starts = ends - lengths[tokens]
    lead = (data & 0xC0) != 0x80
    char_of_byte = np.cumsum(lead) - 1
    return char_of_byte[starts], char_of_byte[ends - 1] + 1


def allocate(first: np.ndarray, past: np.ndarray, bounds: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Section of each token span among the sections that start at
    ``bounds[:-1]`` (``bounds[-1]`` ends the last): allocated section, and the
    sections of its first and last characters."""
    a = np.searchsorted(bounds[:-1], first, "right") - 1
    b = np.searchsorted(bounds[:-1], past - 1, "right") - 1
    if rule == "first":
        return a, a, b
    out = b.copy() if rule == "last" else a.copy()
    if rule == "most":
        for t in np.flatnonzero(a != b):
            parts = np.arange(a[t], b[t] + 1)
            held = np.minimum(bounds[parts + 1], past[t]) - np.maximum(bounds[parts], first[t])
            out[t] = parts[np.argmax(held)]
    return out, a, b


def _sections(fields: Sequence[str]) -> tuple[str, np.ndarray, np.ndarray, np.ndarray]:
    """The whole text; section bounds in characters; the field of each
    section and its place in the field."""
    whole = "\n".join(fields)
    bounds, owner, place = [], [], []
    at = 0
    for f, text in enumerate(fields):
        lines = text.split("\n")
        for n, line in enumerate(lines):
            bounds.append(at)
            owner.append(f)
            place.append(n)
            at += len(line) + 1
    bounds.append(len(whole))
    return whole, np.array(bounds, np.int64), np.array(owner), np.array(place)


def count_sections(fields: Sequence[str], enc, lengths: np.ndarray, rule: str):
    """Per section: field number, place, first and past-the-last character in
    the field, tokens, tokens that cross its bounds."""
    whole, bounds, owner, place = _sections(fields)
    n = len(owner)
    tokens = np.array(enc.encode_ordinary(whole), np.int64)
    counts = crossing = np.zeros(n, np.int64)
    if len(tokens):
        first, past = token_spans(tokens, lengths, np.frombuffer(whole.encode("utf-8"), np.uint8))
        section, a, b = allocate(first, past, bounds, rule)
        counts = np.bincount(section, minlength=n)
        over = a != b
        delta = np.bincount(a[over], minlength=n + 1) - np.bincount(b[over] + 1, minlength=n + 1)[: n + 1]
        crossing = np.cumsum(delta)[:n]
    starts = bounds[np.searchsorted(owner, np.arange(len(fields)))][owner]
    return owner, place, bounds[:-1] - starts, bounds[1:] - starts, counts, crossing


def _count(batches: Iterator[pa.RecordBatch], names: Sequence[str], ranks_file: bytes, pattern: str, rule: str):
    enc, lengths = encoder(ranks_file, pattern)
    for batch in batches:
        out: list[list] = [[] for _ in range(7)]
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            owner, *rest = count_sections([x or "" for x in row[1:]], enc, lengths, rule)
            out[0] += [row[0]] * len(owner)
            out[1] += [names[f] for f in owner]
            for column, values in zip(out[2:], rest, strict=True):
                column += values.tolist()
        types = [pa.int64(), pa.string(), pa.int32(), *[pa.int64()] * 4]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(out, types, strict=True)],
            names=["doc_id", "field", "section", "start_char", "end_char", "n_tokens", "n_crossing"])


def token_counts(
    docs: DataFrame, fields: Sequence[str] = ("text",), rule: str = "most", vocabulary: str = VOCABULARY, pattern: str = PATTERN
) -> DataFrame:
    """One row per section of each document, see ``SCHEMA``: its tokens, and
    how many tokens cross one of its bounds (whichever section they count in).
    ``start_char`` and ``end_char`` are code points in the field, the line
    break included."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    names = list(fields)
    shared = docs.sparkSession.sparkContext.broadcast(Path(vocabulary).read_bytes())
    return arrow_map(
        docs.select("doc_id", *names), lambda b: _count(b, names, shared.value, pattern, rule), SCHEMA)
