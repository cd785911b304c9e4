"""Near-duplicate linking shared by the signature operators.

An operator supplies per document a digest of its shingle set and a list of
band keys; this module turns them into verified links and components:

* documents with one set digest form a class, known by its smallest id, and
  only classes meet in bands, so copies never pair with each other;
* in a band bucket every class is compared with one hub (linear in the
  bucket's size), the class that meets most others in all its buckets; the
  links are contracted, and each class keeps its difference from the hub;
* what then still lies in different components is settled exactly from the
  differences, without pairing the bucket.  The shingles that most classes
  under a hub differ in are moved over to it, which gives their consensus, as
  good as the original of a group of copies.  With d the number of shingles in
  which a class of size n differs from the consensus, two classes are similar
  if and only if E(x) + E(y) <= 2 (100 + percent) * (differences in common),
  where E = (100 + percent) d - (100 - percent) n.  So all classes with
  E(x) + E(least) <= 0 are linked with the least one by their sizes alone.  A
  class beyond that must share differences, as many as the sum of both E says:
  partners meet on the rarest of the differences the far classes have (prefix
  filtering, in ``LEVELS`` levels of E, as a partner of a farther class must
  share more, and only where enough is left of both from there on), and only
  pairs that meet are compared.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import words
from .common import SMALL_ROWS, arrow_map, saved, small, written

#: Labels are propagated this often before the remaining pairs are listed;
#: any number gives the same result, more rounds leave fewer pairs.
CONTRACT_ROUNDS = 2
#: Members of a hub compared in one task.
HUB_SHARE = 512
#: Levels of far classes under a hub; any number gives the same links.
LEVELS = 4


def shingle_set(text: str | None, k: int, lower: bool) -> np.ndarray:
    """Sorted distinct shingle hashes of one text (null: none)."""
    data = np.frombuffer((text or "").encode("utf-8"), np.uint8)
    hashes, rows = words.word_hashes(data, np.array([0, len(data)]), 0, 1, lower=lower)
    return np.unique(words.shingles(hashes, rows, k)[0])


def _compare(batches: Iterator[pa.RecordBatch], k: int, lower: bool, percent: int) -> Iterator[pa.RecordBatch]:
    """Rows (hub, salt, b, text), a hub's own text (b null) before its members',
    to (hub, b, linked, n, diff): b's number of shingles and the shingles that
    only one of the two has."""
    hub_set = None
    for batch in batches:
        linked, sizes, diffs, member = [], [], [], []
        for i, b in enumerate(batch.column(2).to_pylist()):
            own = shingle_set(batch.column(3)[i].as_py(), k, lower)
            if b is None:
                hub_set = own
                continue
            diff = np.setxor1d(own, hub_set, assume_unique=True)
            member.append(i)
            linked.append((100 + percent) * len(diff) <= (100 - percent) * (len(own) + len(hub_set)))
            sizes.append(len(own))
            diffs.append(diff.view(np.int64))
        at = pa.array(member, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(at), batch.column(2).take(at), pa.array(linked, pa.bool_()), pa.array(sizes, pa.int64()), _long_lists(diffs)],
            names=["a", "b", "linked", "n", "diff"])


def _long_lists(rows: list[np.ndarray]) -> pa.ListArray:
    offsets = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([len(r) for r in rows], out=offsets[1:])
    return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([*rows, np.zeros(0, np.int64)])))


def _compared(pairs: DataFrame, texts: DataFrame, k: int, lower: bool, percent: int) -> DataFrame:
    """The pairs (hub a, member b) compared on their full shingle sets.  A hub's
    members are dealt over tasks by a salt, ``HUB_SHARE`` a task; its text goes
    once to each."""
    shares = saved(pairs.groupBy("a").agg(F.floor((F.count(F.lit(1)) - 1) / HUB_SHARE).cast("long").alias("last")))
    members = pairs.join(small(shares), "a").select("a", F.pmod(F.xxhash64("b"), F.col("last") + 1).alias("salt"), "b")
    members = members.join(texts.select(F.col("rep").alias("b"), "text"), "b").select("a", "salt", "b", "text")
    hubs = shares.join(texts.select(F.col("rep").alias("a"), "text"), "a")
    hubs = hubs.select("a", F.explode(F.sequence(F.lit(0).cast("long"), "last")).alias("salt"), F.lit(None).cast("long").alias("b"), "text")
    rows = hubs.union(members).repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
    return arrow_map(
        rows, partial(_compare, k=k, lower=lower, percent=percent), "a long, b long, linked boolean, n long, diff array<long>")


def _propagate(labels: DataFrame, links: DataFrame) -> DataFrame:
    """One round: each node takes the least label around it, then the label
    of its label.  ``labels`` (id, label), ``links`` both ways (u, v)."""
    around = (
        links.join(labels.select(F.col("id").alias("v"), "label"), "v")
        .groupBy(F.col("u").alias("id")).agg(F.min("label").alias("near"))
    )
    stepped = labels.join(around, "id", "left").select("id", "label", F.least("label", "near").alias("next"))
    jump = labels.select(F.col("id").alias("next"), F.col("label").alias("far"))
    return stepped.join(jump, "next", "left").select("id", F.least("next", "far").alias("label"), F.col("label").alias("was"))


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select("b", "a"))


def _first_labels(links: DataFrame) -> DataFrame:
    return links.groupBy(F.col("u").alias("id")).agg(F.least(F.min("v"), F.first("u")).alias("label"))


def components(links: DataFrame) -> DataFrame:
    """Connected components of the links (a, b): (id, label), the label the
    least id reachable.  Rounds of neighbour minimum and label jumping until
    nothing changes, each saved in the shared folder."""
    both = saved(_both_ways(links))
    labels = saved(_first_labels(both))
    while True:
        new = saved(_propagate(labels, both))
        labels = new.select("id", "label")
        if new.where(F.col("label") != F.col("was")).isEmpty():
            return labels


def linked_classes(classes: DataFrame, docs: DataFrame, k: int, lower: bool, percent: int) -> DataFrame:
    """Verified links (a, b) between classes (rep, n, bands array<long>);
    ``docs`` (doc_id, text) holds the representatives' texts.  The links span
    every component: each pair of classes that shares a band is verified,
    joined by verified links, or cannot be similar."""
    members = classes.select("rep", F.explode("bands").alias("key"))
    sizes = members.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = saved(members.join(sizes, "key"))
    popular = shared.groupBy("rep").agg(F.sum("size").alias("met"))
    hub = F.min(F.struct(-F.col("met"), F.xxhash64("rep"), "rep"))
    hubs = shared.join(popular, "rep").groupBy("key").agg(hub.alias("hub")).select("key", F.col("hub.rep").alias("a"))
    tried = saved(shared.join(hubs, "key").where("rep != a").select("a", F.col("rep").alias("b")).distinct())
    wanted = saved(tried.select(F.col("a").alias("rep")).union(tried.select("b")).distinct())
    texts = written(
        docs.select(F.col("doc_id").alias("rep"), "text").join(small(wanted), "rep", "left_semi").dropDuplicates(["rep"]), "near-texts")
    compared = written(_compared(tried, texts, k, lower, percent), "near-compared")
    links = compared.where("linked").select("a", "b")
    return saved(links.union(_beside_hubs(compared, links, percent)))


def _contracted(links: DataFrame) -> DataFrame:
    """(id, label) after a few rounds: equal labels are in one component."""
    both = _both_ways(links)
    labels = _first_labels(both)
    for _ in range(CONTRACT_ROUNDS):
        labels = _propagate(labels, both).select("id", "label")
    return saved(labels)


def _labelled(rows: DataFrame, labels: DataFrame, column: str) -> DataFrame:
    """``rows`` with the label of the class in ``column``; its own without one."""
    named = labels.select(F.col("id").alias(column), F.col("label").alias("known"))
    return rows.join(named, column, "left").withColumn("label", F.coalesce("known", column)).drop("known")


def _beside_hubs(compared: DataFrame, links: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between classes under one hub that the links with the hub
    leave apart; ``compared``: (a, b, linked, n, diff)."""
    more, less = 100 + percent, 100 - percent
    named = _labelled(compared.select("a", "b"), _contracted(links), "b")
    open_hubs = (
        named.groupBy("a").agg(F.count(F.lit(1)).alias("c"), F.min("label").alias("low"), F.max("label").alias("high"))
        .where("c > 1 and low != high").select("a", "c")
    )
    open_hubs = small(saved(open_hubs))
    under = compared.select("a", "b", "n", "diff").join(open_hubs, "a")

    # the consensus: what more than half of the classes have or lack against the hub
    often = under.select("a", "c", F.explode("diff").alias("t")).groupBy("a", "c", "t").agg(F.count(F.lit(1)).alias("m")).where("2 * m > c")
    common = saved(often.groupBy("a").agg(F.collect_list("t").alias("common")))
    if (common.agg(F.sum(F.size("common"))).first()[0] or 0) <= SMALL_ROWS:
        common = F.broadcast(common)
    moved = F.concat(F.array_except("diff", "common"), F.array_except("common", "diff"))
    under = under.join(common, "a", "left").withColumn("diff", F.when(F.col("common").isNull(), F.col("diff")).otherwise(moved))
    far = (F.size("diff") * more - F.col("n") * less).alias("e")
    under = written(under.select("a", "b", "diff", far), "near-differences")
    core = under.groupBy("a").agg(F.min(F.struct("e", "b")).alias("core"))
    core = small(saved(core.select("a", F.col("core.e").alias("least"), F.col("core.b").alias("core"))))
    under = under.join(core, "a")
    by_size = saved(under.where("e + least <= 0 and b != core").select(F.col("core").alias("a"), "b"))

    # what neither the hub nor the consensus links
    labels = small(_contracted(links.union(by_size)))
    main = labels.select(F.col("id").alias("core"), F.col("label").alias("main"))
    under = _labelled(under, labels, "b").join(main, "core", "left").withColumn("main", F.coalesce("main", "core"))
    apart = (F.col("label") != F.col("main")) & (F.col("e") + F.col("least") > 0)
    under = under.select("a", "b", "diff", "e", "label", apart.alias("apart"))
    pairs = _met(under, more)
    ours, theirs = (
        under.select("a", F.col("b").alias(name), F.col("e").alias(f"e_{name}"), F.col("diff").alias(f"diff_{name}")) for name in ("b", "x"))
    both = pairs.join(ours, ["a", "b"]).join(theirs, ["a", "x"])
    similar = F.col("e_b") + F.col("e_x") <= 2 * more * F.size(F.array_intersect("diff_b", "diff_x"))
    return by_size.union(both.where(similar).select(F.col("x").alias("a"), "b"))


def _met(under: DataFrame, more: int) -> DataFrame:
    """Pairs (a, x, b) of a class x apart from its hub's main component and a
    class b that may be similar, from (a, b, diff, e, label, apart)."""
    off = under.where("apart")
    shares = [i / LEVELS for i in range(1, LEVELS)]
    cuts = small(saved(off.groupBy("a").agg(F.percentile_approx("e", shares, 100).alias("cuts"))))
    off = written(off.join(cuts, "a").withColumn("level", F.size(F.filter("cuts", lambda c: F.col("e") > c))).drop("cuts"), "near-apart")
    lows = small(saved(off.groupBy("a", "level").agg(F.min("e").alias("low"))))
    held = off.select("a", "level", F.col("b").alias("x"), F.col("label").alias("label_x"), F.col("e").alias("e_x"), F.size("diff").alias("d_x"),
                      F.explode("diff").alias("t"))
    often = held.groupBy("a", "level", "t").agg(F.count(F.lit(1)).alias("times"))
    mine = Window.partitionBy("a", "level", "x").orderBy("times", "t")
    held = held.join(often, ["a", "level", "t"]).withColumn("left_x", F.col("d_x") - F.row_number().over(mine) + 1).drop("times", "d_x")
    able = under.join(lows, "a").where(F.col("e") + F.col("low") <= 2 * more * F.size("diff"))
    offered = able.select("a", "level", "low", "b", "label", "e", F.explode("diff").alias("t")).join(often, ["a", "level", "t"])
    own = Window.partitionBy("a", "level", "b")
    least = F.greatest(F.ceil((F.col("e") + F.col("low")) / (2 * more)), F.lit(1))
    offered = (
        offered.withColumn("place", F.row_number().over(own.orderBy("times", "t"))).withColumn("usable", F.count(F.lit(1)).over(own))
        .where(F.col("place") <= F.col("usable") - least + 1)
    )
    # from their first common difference on, no more can be common than what is left of either
    able_by_size = F.col("e_x") + F.col("e") <= 2 * more * F.least(F.col("usable") - F.col("place") + 1, "left_x")
    return offered.join(held, ["a", "level", "t"]).where((F.col("label") != F.col("label_x")) & able_by_size).select("a", "x", "b").distinct()


def near_components(signed: DataFrame, docs: DataFrame, k: int, lower: bool, percent: int) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``signed``
    (doc_id, n_shingles, digest, bands; digest null: an empty set)."""
    full = signed.where("digest is not null and doc_id is not null")
    classes = saved(
        full.groupBy("digest").agg(
            F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.min_by("bands", "doc_id").alias("bands"))
    )
    labels = components(linked_classes(classes, docs, k, lower, percent))
    of_class = (
        classes.select("digest", "rep").join(labels.withColumnRenamed("id", "rep"), "rep", "left")
        .select("digest", F.coalesce("label", "rep").alias("component"))
    )
    return (
        signed.join(of_class, "digest", "left")
        .select("doc_id", "n_shingles",
                F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
    )


def signed_by(
    docs: DataFrame, coordinates: Callable[[np.ndarray, np.ndarray], np.ndarray], k: int, lower: bool, band_rows: int
) -> DataFrame:
    """(doc_id, n_shingles, digest, bands) per row of ``docs`` (doc_id, text).

    ``coordinates(hashes, rows)`` gives each row's signature; ``band_rows``
    successive coordinates make one band key.
    """
    work = partial(_sign, coordinates=coordinates, k=k, lower=lower, band_rows=band_rows)
    return arrow_map(
        docs.select("doc_id", "text"), work, "doc_id long, n_shingles long, digest binary, bands array<long>")


def band_keys(signature: np.ndarray, band_rows: int) -> np.ndarray:
    """One 64-bit key per band of each row's signature."""
    n, width = signature.shape
    grouped = signature.reshape(n, width // band_rows, band_rows).astype(np.uint64)
    keys = np.broadcast_to(np.arange(width // band_rows, dtype=np.uint64), grouped.shape[:2]).copy()
    for r in range(band_rows):
        keys = keys * words.BASE + grouped[:, :, r] * words.ROLL + np.uint64(r + 1)
        keys ^= keys >> np.uint64(29)
    return words.mix(keys)


def _sign(batches: Iterator[pa.RecordBatch], coordinates, k: int, lower: bool, band_rows: int) -> Iterator[pa.RecordBatch]:
    import hashlib

    for batch in batches:
        data, offsets = words.column_bytes(batch.column(1))
        for i, j in words.slices(offsets):
            hashes, rows = words.word_hashes(data, offsets, i, j, lower=lower)
            hashes, rows = words.shingles(hashes, rows, k)
            bands = band_keys(coordinates(hashes, rows), band_rows)
            sizes, digests = [], []
            for r in range(j - i):
                own = np.unique(hashes[rows[r] : rows[r + 1]])
                sizes.append(len(own))
                digests.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None)
            per_row = bands.shape[1]
            lists = pa.ListArray.from_arrays(
                np.arange(0, bands.size + 1, per_row, dtype=np.int32), pa.array(bands.ravel().view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, j - i), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), lists],
                names=["doc_id", "n_shingles", "digest", "bands"])
