"""Operator 12: a Merkle manifest of a dataset by slot pivots.

Every row is a leaf, the hash of its columns.  The leaves of a group (a
source) are numbered in key order and every ``FANOUT`` consecutive nodes
become one parent, until one node, the group's subroot, remains; the subroots,
in the order of their groups, give the root the same way.

A level is one grouped aggregate: conditional aggregates spread the children
of each parent into the columns ``c0`` .. ``c15``.  Concatenating the columns
hashes the parent; leaving out a child's own column gives its siblings.  Going
down again each parent hands its children the siblings of all levels above,
so a proof is put together from one row per parent and level, and each leaf
row is shuffled once.  Places come from a range-partitioned sort: a row's
place in its group is its place in its partition plus the counts of the
earlier partitions, so a group with a third of all rows is numbered by many
tasks.

``verify`` folds a leaf, or the leaf of a changed row, with its siblings up to
the root.

Edge cases: a null column is hashed as ``-`` and so differs from an empty one;
empty and very long texts are ordinary values (a leaf is hashed in its own
row); the rows of a null group are a group of their own, first in order; a
null key comes first in its group; rows with equal keys are ordered by their
leaf hash, so repeated rows stand side by side and each has its own proof; an
empty table has no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import join_null_safe, saved, shuffle_partitions, small, written

FANOUT = 16
SLOTS = [f"c{k}" for k in range(FANOUT)]
#: The columns a document's leaf is made of, in order.
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts one after the other."""
    return F.sha2(F.concat(*parts), 256)


def framed(value: Column) -> Column:
    """A value with its length in bytes in front; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(columns: Sequence[Column]) -> Column:
    return digest(*(framed(c) for c in columns))


@dataclass
class Tree:
    """The levels of one tree per group ``g``.  ``levels[i]`` holds the parents
    of the nodes at height i: (g, n, idx, h, c0 .. c15), ``n`` the nodes of the
    group at their own height.  ``tops``: (g, height, h), the last node of each."""

    levels: list[DataFrame]
    tops: DataFrame


def _pivot(nodes: DataFrame, value: Column) -> DataFrame:
    """Nodes (g, n, idx, ...) to one row per parent with ``value`` of each
    child in its slot."""
    slot = F.pmod("idx", F.lit(FANOUT))
    return nodes.groupBy(
        "g", F.ceil(F.col("n") / F.lit(FANOUT)).cast("long").alias("n"), F.floor(F.col("idx") / F.lit(FANOUT)).cast("long").alias("idx"),
        (F.col("n") == 1).alias("lone"),
    ).agg(*(F.max(F.when(slot == k, value)).alias(c) for k, c in enumerate(SLOTS)))


def _parent_hash(field: str = "") -> Column:
    return digest(*(F.coalesce(F.col(c + field), F.lit("")) for c in SLOTS))


def _grow(nodes: DataFrame, most: int, start: int, levels: list[DataFrame], name: str) -> Tree:
    """Levels above ``nodes`` (g, n, idx, h) until every group has one node;
    ``most`` is the largest n."""
    tops, height = [], start
    while True:
        tops.append(nodes.where("n = 1").select("g", F.lit(height).alias("height"), "h"))
        if most <= 1:
            return Tree(levels, reduce(DataFrame.union, tops))
        parents = written(_pivot(nodes.where("n > 1"), F.col("h")).drop("lone").withColumn("h", _parent_hash()), f"{name}-{height}")
        levels.append(parents)
        nodes, most, height = parents.select("g", "n", "idx", "h"), -(-most // FANOUT), height + 1


def _around(hashes: Column, k: Column) -> Column:
    """What stands left and right of slot ``k`` in its run."""
    return F.struct(
        F.array_join(F.slice(hashes, 1, k), "").alias("left"), F.array_join(F.slice(hashes, k + 2, FANOUT), "").alias("right"))


def _children(parents: DataFrame) -> DataFrame:
    """Parents (g, idx, c0 .., path, subroot, root) to their children (g, idx, path, ...)."""
    kids = F.array(*SLOTS)
    rows = F.transform(
        kids, lambda h, k: F.struct(h.alias("h"), (F.col("idx") * FANOUT + k).alias("at"), _around(kids, k).alias("around")))
    each = parents.select("g", "path", "subroot", "root", F.explode(F.filter(rows, lambda x: x["h"].isNotNull())).alias("x"))
    return each.select("g", F.col("x.at").alias("idx"), F.concat(F.array("x.around"), "path").alias("path"), "subroot", "root")


def _descend(tree: Tree, given: DataFrame, down_to: int) -> DataFrame:
    """Paths of the nodes at height ``down_to``: (g, idx, path, subroot,
    root).  ``given`` (g, height, path, subroot, root) are those of the tops."""
    top = lambda height: given.where(F.col("height") == height).select("g", F.lit(0).cast("long").alias("idx"), "path", "subroot", "root")
    paths = None
    for height in range(len(tree.levels) + down_to, down_to, -1):
        above = top(height) if paths is None else paths.union(top(height))
        parents = tree.levels[height - 1 - down_to].drop("n", "h").join(above, ["g", "idx"])
        paths = _children(parents)
    return top(down_to) if paths is None else paths.union(top(down_to))


NO_PATH = "cast(array() as array<struct<left:string,right:string>>)"


def numbered(rows: DataFrame, group: str, order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``rows`` with ``g`` (the place of their group among the groups), ``idx``
    (their place in the group by ``order``) and ``n`` (the group's rows); and
    the groups (g, group, n).  Nulls come first."""
    spark = rows.sparkSession
    parts = shuffle_partitions(spark)
    cols = [F.col(c).asc_nulls_first() for c in (group, *order)]
    stored = written(
        rows.repartitionByRange(parts, *cols).sortWithinPartitions(*cols).withColumn("mid", F.monotonically_increasing_id()), "merkle-order")
    part = F.shiftright("mid", 33).alias("part")
    runs = stored.groupBy(F.col(group).alias("group"), part).agg(F.min("mid").alias("first"), F.count(F.lit(1)).alias("rows"))
    runs = saved(runs)
    groups = runs.groupBy("group").agg(F.min("part").alias("part"), F.sum("rows").alias("n"))
    # the groups that begin in a partition are ordered there; one row per partition carries the count on
    starting = groups.groupBy("part").agg(F.count(F.lit(1)).alias("k"))
    before = F.sum("k").over(Window.orderBy("part")) - F.col("k")
    place = F.row_number().over(Window.partitionBy("part").orderBy(F.col("group").asc_nulls_first())) - 1
    groups = groups.join(starting.select("part", before.alias("before")), "part").select((F.col("before") + place).alias("g"), "group", "n")
    groups = saved(groups)
    earlier = F.sum("rows").over(Window.partitionBy("group").orderBy("part")) - F.col("rows")
    runs = join_null_safe(runs.withColumn("earlier", earlier), groups, ["group"])
    runs = saved(runs.select("group", "part", "first", "earlier", "g", "n"))
    keyed = stored.withColumn("group", F.col(group)).withColumn("part", part)
    placed = join_null_safe(keyed, small(runs), ["group", "part"])
    return placed.withColumn("idx", F.col("mid") - F.col("first") + F.col("earlier")).drop("group", "part", "mid", "first", "earlier"), groups


def proofs(rows: DataFrame, group: str, keep: Sequence[str]) -> DataFrame:
    """``rows`` (``group``, ``key``, ``leaf``, ...) with their proofs: the
    columns ``keep``, leaf, subroot, root and ``path``, an array of what
    stands left and right of the node on every level from the leaf up."""
    placed, groups = numbered(rows, group, ("key", "leaf"))
    value = F.struct("leaf", *keep)
    most, many = groups.agg(F.coalesce(F.max("n"), F.lit(0)), F.count(F.lit(1))).first()
    first = written(
        _pivot(placed.select("g", "n", "idx", *("leaf", *keep)), value)
        .withColumn("h", F.when(F.col("lone"), F.col("c0.leaf")).otherwise(_parent_hash(".leaf"))), "merkle-leaves")
    tree = _grow(first.select("g", "n", "idx", "h"), -(-most // FANOUT), 1, [], "merkle-node")

    subroots = saved(tree.tops)
    count = F.lit(many).cast("long").alias("n")
    upper = _grow(subroots.select(F.lit(0).cast("long").alias("g"), count, F.col("g").alias("idx"), "h"), many, 0, [], "merkle-source")
    roots = upper.tops.select("g", "height", F.expr(NO_PATH).alias("path"), F.lit("").alias("subroot"), F.col("h").alias("root"))
    over = _descend(upper, roots, 0).select(F.col("idx").alias("g"), "path", "root")
    given = saved(subroots.join(small(saved(over)), "g").select("g", "height", "path", F.col("h").alias("subroot"), "root"))
    paths = _descend(tree, given, 1)

    under = first.drop("n", "h").join(paths, ["g", "idx"])
    leaves = F.array(*(F.col(f"{c}.leaf") for c in SLOTS))
    slots = F.transform(F.array(*SLOTS), lambda row, k: F.struct(row.alias("row"), _around(leaves, k).alias("around")))
    each = under.select("lone", "path", "subroot", "root", F.explode(F.filter(slots, lambda x: x["row"].isNotNull())).alias("x"))
    whole = F.when(F.col("lone"), F.col("path")).otherwise(F.concat(F.array("x.around"), "path"))
    return each.select(*(F.col(f"x.row.{c}").alias(c) for c in (*keep, "leaf")), "subroot", "root", whole.alias("path"))


def proof_hash(path: str = "path") -> Column:
    """Hash of all siblings from the leaf's run to the root's."""
    return F.sha2(F.array_join(F.transform(path, lambda x: F.concat(x["left"], x["right"])), ""), 256)


def folded(leaf: Column, path: str = "path") -> Column:
    """The root that ``leaf`` gives with the siblings of ``path``."""
    return F.aggregate(path, leaf, lambda h, x: digest(x["left"], h, x["right"]))


def verify(docs: DataFrame, changed: Column, altered: dict[str, Column], group: str = "source", key: str = "doc_id",
           columns: Sequence[str] = LEAF_COLUMNS) -> DataFrame:
    """The manifest of ``docs`` checked against tampered rows: where
    ``changed`` holds, the columns ``altered`` replace the row's own.  Per row:
    ``key``, leaf, subroot, root and proof_sha256 of the untampered table, the
    root folded from the tampered row, and whether that is the root."""
    tampered = leaf_hash([altered.get(c, F.col(c)) for c in columns])
    leaves = written(
        docs.select(
            F.col(group).alias("group_key"), F.col(key).alias("key"), leaf_hash([F.col(c) for c in columns]).alias("leaf"),
            F.when(changed, tampered).alias("tampered")), "merkle-leaf")
    held = proofs(leaves, "group_key", ["key", "tampered"])
    root = folded(F.coalesce("tampered", "leaf"))
    return held.select(
        F.col("key").alias(key), "leaf", "subroot", "root", proof_hash().alias("proof_sha256"), root.alias("folded_root"),
        (root == F.col("root")).alias("verified"))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def every_fifth(key: Column) -> Column:
    return F.crc32(key.cast("string").cast("binary")) % 5 == 0
