"""Operator 13: alignment of two tokenizers by inverted pair bitmaps.

Each document is encoded once by a byte-level BPE (A) and a piece model (B).
Both token sequences cover the same bytes, so the ends of either cut the text
into segments that lie in one A token and one B token: each segment is a link.
Ends that both have in common cut the tokens into groups.

Documents are taken in chunks of at most ``CHUNK_DOCS``; a document's slot is
its place in the chunk.  For every pair (A id, B id) of a chunk the task writes
an inverted list as compressed bitmaps of slots: plane 0 holds the documents
with the pair, planes 1, 2, ... the binary digits of how many links more than
one they have.  A bitmap with few slots is a list of 16-bit slots, one with
many is a field of bits (``FIELD_BYTES``), whichever is shorter, as in roaring
bitmaps.  ``merged`` unites bitmaps of one (pair, chunk, plane), which a plain
run never makes, with OR; popcounts of plane 0 give document counts, popcounts
of all planes, weighted, the links.

The pairs' counts go back through the postings: each bitmap gets the count of
its pair and pays it to the documents whose slots it holds.  Documents never
meet documents; a pair that every document has is one small bitmap per chunk.

Edge cases: texts that are null or empty, or whose joined tokens are not the
bytes of a space and the text, have no tokens: zeros and an empty
``groups_sha256``; the texts of special tokens are ordinary text; a very long
text is a chunk of its own, encoded whole; of equally frequent A ids of a B id
all are best; a null doc_id is kept, repeated rows count and are given again;
an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from functools import partial
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, few, saved, written

A_FILE = "/opt/tokenizers/byte_bpe_50k.json"
B_FILE = "/opt/tokenizers/piece_bpe_32k.model"

#: Fixed value: the split pattern of byte-level files.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Slots of a chunk; a bit field of so many is as long as a list of a sixteenth.
CHUNK_DOCS = 4096
FIELD_BYTES = CHUNK_DOCS // 8
#: A chunk is closed when its texts have so many bytes, whatever their number.
CHUNK_BYTES = 1 << 23
#: Texts encoded at a time.
BATCH_BYTES = 1 << 20

ENCODED = (
    "chunk long, slot int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "pair long, plane int, bits binary")
_loaded: dict = {}


def byte_of_char() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for: printable
    Latin characters stand for themselves, the other bytes for characters from
    256 on, in order."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    moved = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(moved)}


class Vocabulary:
    """The bytes of every token, one after the other."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])[:-1]
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of a token sequence."""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        at = np.repeat(self.starts[ids] - (ends - lengths), lengths)
        at += np.arange(len(at))
        return self.flat[at]


class Encoders:
    """Both tokenizers and their tables, built once per process."""

    def __init__(self, a_json: bytes, b_model: bytes) -> None:
        import sentencepiece

        byte_of = byte_of_char()
        spec = json.loads(a_json)
        by_id = {i: bytes(byte_of[c] for c in t) for t, i in spec["model"]["vocab"].items()}
        special = {t["id"]: t["content"].encode("utf-8") for t in spec["added_tokens"]}
        size = max([*by_id, *special]) + 1
        self.a_bytes = Vocabulary([special.get(i, by_id.get(i, b"")) for i in range(size)])
        self.a = byte_level_encoder(a_json, spec, {t: i for i, t in by_id.items() if i not in special})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = Vocabulary([
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode("utf-8") for i, p in enumerate(pieces)])
        # decimal ids with what follows them: A within a group, A last, B within, B last
        self.sizes = size, len(pieces)
        self.names = Vocabulary([f"{i}{end}".encode() for n, ends in ((size, ",|"), (len(pieces), ",;")) for end in ends for i in range(n)])

    def both(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """A and B ids of each text; none where they do not give its bytes."""
        a_all = [self.a(" " + t) for t in texts]
        b_all = self.b.encode(texts, num_threads=1)
        none = np.zeros(0, np.int64)
        out = []
        for text, a, b in zip(texts, a_all, b_all, strict=True):
            b = np.array(b, np.int64)
            raw = np.frombuffer((" " + text).encode("utf-8"), np.uint8)
            exact = len(text) > 0 and np.array_equal(self.a_bytes.joined(a), raw) and np.array_equal(self.b_bytes.joined(b), raw)
            out.append((a, b) if exact else (none, none))
        return out


def byte_level_encoder(a_json: bytes, spec: dict, ranks: dict[bytes, int]) -> Callable[[str], np.ndarray]:
    """The encoder of a byte-level BPE file.  Where its merges are in the order
    of its ids, as in the public files, and it splits by the usual pattern, the
    ids serve as ranks of the faster library; else the file's own library
    encodes.  The texts of special tokens are ordinary text in both."""
    import tiktoken

    byte_of, splits = byte_of_char(), spec.get("pre_tokenizer") or {}
    joined = [bytes(byte_of[c] for c in "".join(m.split(" ") if isinstance(m, str) else m)) for m in spec["model"]["merges"]]
    whole = len(ranks) == 256 + len(joined) and all(ranks.get(t) == 256 + i for i, t in enumerate(joined))
    plain = splits.get("type") == "ByteLevel" and splits.get("use_regex") and not splits.get("add_prefix_space") and not spec.get("normalizer")
    if whole and plain:
        enc = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        return lambda text: enc.encode_to_numpy(text, disallowed_special=()).astype(np.int64)
    from tokenizers import Tokenizer

    own = Tokenizer.from_str(a_json.decode("utf-8"))
    own.encode_special_tokens = True
    return lambda text: np.array(own.encode(text, add_special_tokens=False).ids, np.int64)


def encoders(a_json: bytes, b_model: bytes) -> Encoders:
    key = hashlib.md5(a_json).digest() + hashlib.md5(b_model).digest()
    if key not in _loaded:
        _loaded[key] = Encoders(a_json, b_model)
    return _loaded[key]


def aligned(a: np.ndarray, b: np.ndarray, enc: Encoders) -> tuple[np.ndarray, int, str]:
    """The links of a document as pairs (A id << 32 | B id), its number of
    groups, and their hash."""
    if not len(a):
        return np.zeros(0, np.int64), 0, ""
    a_ends, b_ends = np.cumsum(enc.a_bytes.lengths[a]), np.cumsum(enc.b_bytes.lengths[b])
    mark = np.zeros(int(a_ends[-1]) + 1, np.uint8)
    mark[a_ends] = 1
    mark[b_ends] |= 2
    kind = mark[np.flatnonzero(mark)]  # of each segment's end: 1 A's, 2 B's, 3 both
    of_a, of_b, both = kind & 1 == 1, kind & 2 == 2, kind == 3
    a_upto, b_upto, group = np.cumsum(of_a), np.cumsum(of_b), np.cumsum(both)
    links = (a[a_upto - of_a] << 32) | b[b_upto - of_b]
    # tokens in order of their group, A before B: a token stands behind those of the groups before, B also behind its own group's A
    group -= both
    a_group, b_group = group[of_a], group[of_b]
    a_done, b_done = a_upto[both], np.append(0, b_upto[both])
    order = np.empty(len(a) + len(b), np.int64)
    order[np.arange(len(a)) + b_done[a_group]] = a + both[of_a] * enc.sizes[0]
    order[np.arange(len(b)) + a_done[b_group]] = b + (2 * enc.sizes[0] + both[of_b] * enc.sizes[1])
    return links, len(a_done), hashlib.sha256(enc.names.joined(order)[:-1].tobytes()).hexdigest()


def bitmaps(slots: np.ndarray, starts: np.ndarray) -> pa.Array:
    """Compressed bitmaps of the sorted slots ``slots[starts[i]:starts[i + 1]]``."""
    counts = np.diff(starts)
    dense = counts * 2 >= FIELD_BYTES
    lengths = np.where(dense, FIELD_BYTES, counts * 2)
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    out = np.zeros(int(offsets[-1]), np.uint8)
    thin = np.repeat(~dense, counts)
    raw = slots.astype("<u2").view(np.uint8).reshape(-1, 2)[thin]
    at = np.repeat(offsets[:-1][~dense] - 2 * np.concatenate([[0], np.cumsum(counts[~dense])])[:-1], counts[~dense]) + 2 * np.arange(len(raw))
    out[at], out[at + 1] = raw[:, 0], raw[:, 1]
    for i in np.flatnonzero(dense):
        field = np.zeros(CHUNK_DOCS, np.uint8)
        field[slots[starts[i] : starts[i + 1]]] = 1
        out[offsets[i] : offsets[i + 1]] = np.packbits(field, bitorder="little")
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(out)])


def slots_of(bits: bytes) -> np.ndarray:
    """The slots a compressed bitmap holds."""
    if len(bits) < FIELD_BYTES:
        return np.frombuffer(bits, "<u2").astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little"))


def inverted(links: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """The postings of a chunk whose document at slot i has ``links[i]``:
    pairs, planes, bitmaps."""
    sizes = np.array([len(x) for x in links], np.int64)
    keys = np.concatenate([np.zeros(0, np.int64), *links])
    slots = np.repeat(np.arange(len(links)), sizes)
    order = np.lexsort((slots, keys))
    keys, slots = keys[order], slots[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (slots[1:] != slots[:-1])
    first = np.flatnonzero(new)
    more = np.diff(np.append(first, len(keys))) - 1  # links beyond the first
    keys, slots = keys[first], slots[first]
    pairs, planes, held, starts, total = [], [], [], [np.zeros(1, np.int64)], 0
    plane = 0
    while len(keys):
        have = slice(None) if plane == 0 else (more >> (plane - 1)) & 1 == 1
        k, s = keys[have], slots[have]
        edge = np.flatnonzero(np.append(True, k[1:] != k[:-1])) if len(k) else np.zeros(0, np.int64)
        pairs.append(k[edge])
        planes.append(np.full(len(edge), plane, np.int32))
        held.append(s)
        starts.append(total + np.append(edge[1:], len(k)) if len(edge) else np.zeros(0, np.int64))
        total += len(k)
        left = more >> plane > 0
        keys, slots, more = keys[left], slots[left], more[left]
        plane += 1
    empty = np.zeros(0, np.int64)
    return (
        np.concatenate([empty, *pairs]), np.concatenate([empty.astype(np.int32), *planes]),
        bitmaps(np.concatenate([empty, *held]), np.concatenate(starts)))


def _encode(batches: Iterator[pa.RecordBatch], a_json, b_model) -> Iterator[pa.RecordBatch]:
    """Documents (doc_id, text) to the rows of each chunk: one per document,
    one per posting bitmap (``ENCODED``)."""
    enc = encoders(a_json.value, b_model.value)
    part = TaskContext.get().partitionId()
    ids, links, rows, size, done = [], [], [], 0, 0

    def close() -> pa.RecordBatch:
        pairs, planes, bits = inverted(links)
        n, m = len(ids), len(pairs)
        none = lambda kind, k: pa.nulls(k, kind)
        of_doc = [pa.array(ids, pa.int64()), *(pa.array([r[i] for r in rows], pa.int64()) for i in range(4)), pa.array([r[4] for r in rows], pa.string())]
        whole = [pa.concat_arrays([c, none(c.type, m)]) for c in of_doc]
        post = [pa.array(pairs, pa.int64()), pa.array(planes, pa.int32()), bits]
        whole += [pa.concat_arrays([none(c.type, n), c]) for c in post]
        chunk = pa.array(np.full(n + m, (part << 32) + done), pa.int64())
        slot = pa.concat_arrays([pa.array(np.arange(n), pa.int32()), none(pa.int32(), m)])
        return pa.RecordBatch.from_arrays([chunk, slot, *whole], names=[c.split()[0] for c in ENCODED.split(", ")])

    for batch in batches:
        texts = [t or "" for t in batch.column(1).to_pylist()]
        doc_ids = batch.column(0).to_pylist()
        i = 0
        while i < len(texts):
            j, held = i, 0
            while j < len(texts) and (j == i or (held < BATCH_BYTES and len(ids) + j - i < CHUNK_DOCS)):
                held += len(texts[j])
                j += 1
            for doc_id, (a, b) in zip(doc_ids[i:j], enc.both(texts[i:j]), strict=True):
                found, n_groups, digest = aligned(a, b, enc)
                ids.append(doc_id)
                links.append(found)
                rows.append((len(a), len(b), n_groups, len(found), digest))
            size += held
            i = j
            if len(ids) >= CHUNK_DOCS or size >= CHUNK_BYTES:
                yield close()
                ids, links, rows, size, done = [], [], [], 0, done + 1
    if ids:
        yield close()


def encoded(docs: DataFrame, a_file: str = A_FILE, b_file: str = B_FILE) -> DataFrame:
    """Documents and their postings, written once (``ENCODED``): rows with
    ``slot`` are documents, rows with ``pair`` are bitmaps."""
    sc = docs.sparkSession.sparkContext
    a_json, b_model = sc.broadcast(Path(a_file).read_bytes()), sc.broadcast(Path(b_file).read_bytes())
    work = partial(_encode, a_json=a_json, b_model=b_model)
    return written(arrow_map(docs.select("doc_id", "text"), work, ENCODED), "alignment")


def _unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [np.unique(np.concatenate([slots_of(b) for b in many])) for many in batch.column(3).to_pylist()]
        starts = np.concatenate([[0], np.cumsum([len(s) for s in out])]).astype(np.int64)
        bits = bitmaps(np.concatenate([np.zeros(0, np.int64), *out]), starts)
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], bits], names=["chunk", "pair", "plane", "bits"])


def merged(postings: DataFrame) -> DataFrame:
    """Bitmaps of the same (chunk, pair, plane), as when the postings of
    several loads over the same documents come together, united by OR."""
    many = postings.groupBy("chunk", "pair", "plane").agg(F.collect_set("bits").alias("bits"))
    return arrow_map(many, _unite, "chunk long, pair long, plane int, bits binary")


def popcount() -> F.Column:
    """Slots in the bitmap ``bits``."""
    size = F.octet_length("bits")
    return F.when(size < FIELD_BYTES, F.shiftright(size, 1).cast("long")).otherwise(F.expr("bitmap_count(bits)"))


def weight() -> F.Column:
    """Links a slot in plane ``plane`` stands for."""
    return F.when(F.col("plane") == 0, F.lit(1).cast("long")).otherwise(F.expr("shiftleft(1L, plane - 1)"))


def pair_counts(postings: DataFrame) -> DataFrame:
    """Postings (pair, plane, bits) to (pair, n_docs, n_links, best): in how
    many documents and how often A and B tokens of the pair are linked, and
    whether no other A id is linked with the B id more often."""
    counted = postings.select("pair", "plane", popcount().alias("n"), weight().alias("w"))
    pairs = saved(counted.groupBy("pair").agg(
        F.sum(F.when(F.col("plane") == 0, F.col("n")).otherwise(0)).alias("n_docs"), F.sum(F.col("n") * F.col("w")).alias("n_links")))
    b = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    most = pairs.groupBy(b.alias("b")).agg(F.max("n_links").alias("most"))
    return pairs.withColumn("b", b).join(most, "b").select("pair", "n_docs", "n_links", (F.col("n_links") == F.col("most")).alias("best"))


def _pay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (chunk, bits, w, n_links, best) to sums per document of the batch:
    (chunk, slot, n_best, count_sum)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        bits = [slots_of(b) for b in batch.column(1).to_pylist()]
        sizes = np.array([len(s) for s in bits])
        chunks, chunk = np.unique(batch.column(0).to_numpy(), return_inverse=True)
        place = np.repeat(chunk, sizes) * CHUNK_DOCS + np.concatenate(bits)
        w, n = batch.column(2).to_numpy(), batch.column(3).to_numpy()
        best = batch.column(4).to_numpy(zero_copy_only=False)
        places, at = np.unique(place, return_inverse=True)
        sums = [np.zeros(len(places), np.int64) for _ in range(2)]
        for total, values in zip(sums, (w * best, w * n), strict=True):
            np.add.at(total, at, np.repeat(values.astype(np.int64), sizes))
        yield pa.RecordBatch.from_arrays(
            [pa.array(chunks[places // CHUNK_DOCS]), pa.array((places % CHUNK_DOCS).astype(np.int32)), *map(pa.array, sums)],
            names=["chunk", "slot", "n_best", "count_sum"])


def alignment(docs: DataFrame, a_file: str = A_FILE, b_file: str = B_FILE) -> DataFrame:
    """Per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256 (see the module)."""
    rows = encoded(docs, a_file, b_file)
    postings = rows.where("pair is not null").select("chunk", "pair", "plane", "bits")
    pairs = saved(pair_counts(postings).select("pair", "n_links", "best"))
    if few(pairs):
        scored = postings.join(F.broadcast(pairs), "pair")
    else:
        scored = postings.join(pairs, "pair").repartition("chunk").sortWithinPartitions("chunk")
    paid = arrow_map(
        scored.select("chunk", "bits", weight().alias("w"), "n_links", "best"), _pay, "chunk long, slot int, n_best long, count_sum long")
    sums = paid.groupBy("chunk", "slot").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    zero = F.lit(0).cast("long")
    return rows.where("slot is not null").join(sums, ["chunk", "slot"], "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")
