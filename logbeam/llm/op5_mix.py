"""Operator 5: mixing sources to target weights by Sainte-Lague apportionment.

All DataFrame functions.  The size of a document is its number of words.
Sources take weights in code-point order; a source's target is its share of
all words, held to ``MAX_REPEATS`` times its own size, the excess going to the
others by weight until none is above.  Targets become integer quotas of
equal-token blocks: the blocks of the whole mix go one by one to the source
with the highest quotient ``target / (2 k + 1)``, and each source's blocks are
shared out to its shards the same way by shard size.  A shard is a seeded
order of documents read as one stream of words and cut into blocks; it gives
every block ``quota // blocks`` times and a seeded choice of the rest once
more.

The quotients are ranked only where they can decide: with the divisor
``all targets / blocks`` a source's count lies within its exact share less or
more a margin that the number of sources sets, so every count starts from
the safe part and a few quotients a source compete for the rest.  The
windows over whole tables run on one row per source or quotient, never on
documents; documents meet only in shards of about ``shard_words`` words.

Edge cases: a null or empty text has size 0 and nothing is taken of it; a
null source is a source of its own, last in order; repeated rows count
each on their own; an empty table gives an empty result; a null doc_id is
hashed like a value; a very long text is cut into blocks like any other; ties in
the seeded order go by doc_id and size; input columns named like the added ones are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import join_null_safe, saved, scratch_name, small

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
BLOCK_WORDS = 16
SHARD_WORDS = 1 << 20
SEED = 11


def seeded(seed: int, *parts: Column) -> Column:
    """A reproducible 60-bit number of the parts."""
    text = F.concat_ws("|", F.lit(str(seed)), *(F.coalesce(p.cast("string"), F.lit("~")) for p in parts))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``sources`` (source, source_size) with weight and target.

    Sources in the order of cap / weight: those up to some point are held to
    their caps, the others share what is left by weight, so the point is
    found from running sums alone.
    """
    ordered = W.orderBy(F.col("source").isNull(), "source")
    by_cap = W.orderBy("ratio", "rank").rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy()
    ranked = sources.withColumn("rank", F.row_number().over(ordered) - 1)
    weighted = ranked.withColumn(
        "weight", F.element_at(F.array(*(F.lit(w) for w in weights)), (F.col("rank") % len(weights) + 1).cast("int")))
    capped = (
        weighted.withColumn("cap", F.col("source_size") * max_repeats)
        .withColumn("ratio", F.col("cap").cast("double") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("left", F.col("total") - F.coalesce(F.sum("cap").over(by_cap), F.lit(0)))
        .withColumn("weight_left", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(by_cap), F.lit(0)))
        .withColumn("level", F.col("left").cast("double") / F.col("weight_left"))
    )
    held = F.col("ratio") <= F.col("level")
    # the level that holds for all sources that are not at their caps
    shared = capped.withColumn("common", F.max(F.when(~held, F.col("level"))).over(everything))
    target = F.when(held, F.col("cap").cast("double")).otherwise(F.col("common") * F.col("weight"))
    return shared.select("source", "source_size", "weight", "total", target.alias("target"))


def apportion(votes: DataFrame, group: list[str], name: str, seats: str, most: str) -> DataFrame:
    """``votes`` (group columns, ``name``, vote double, ``seats`` long, ``most``
    long) with ``quota``: within each group the seats go by highest quotients
    vote / (2 k + 1), ties to the lower name, nobody above ``most``.
    """
    whole = W.partitionBy(*group)
    exact = F.when(F.col("_all") > 0, F.col("vote") * F.col(seats) / F.col("_all")).otherwise(0.0)
    slack = exact * F.col("_n") / F.greatest(F.col(seats), F.lit(1))
    base = votes.withColumn("_all", F.sum("vote").over(whole)).withColumn("_n", F.count(F.lit(1)).over(whole))
    base = base.withColumn("_low", F.greatest(F.floor(exact - slack) - 1, F.lit(0)).cast("long"))
    base = base.withColumn("_low", F.least("_low", F.col(most)))
    base = base.withColumn("_high", F.least(F.ceil(exact + slack).cast("long") + 2, F.col(most)))
    base = base.withColumn("_open", F.col(seats) - F.sum("_low").over(whole))
    quotients = base.where("_high > _low and vote > 0").withColumn("_k", F.explode(F.sequence("_low", F.col("_high") - 1)))
    order = W.partitionBy(*group).orderBy(
        (F.col("vote") / (F.col("_k") * 2 + 1)).desc(), F.col(name).isNull(), name, "_k")
    won = (
        quotients.withColumn("_rank", F.row_number().over(order)).where("_rank <= _open")
        .groupBy(*group, name).agg(F.count(F.lit(1)).alias("_won"))
    )
    counted = join_null_safe(base, won, [*group, name], "left")
    return counted.select(*votes.columns, (F.col("_low") + F.coalesce("_won", F.lit(0))).alias("quota"))


def _chosen(docs: DataFrame, weights, max_repeats: int, block_words: int, shard_words: int, seed: int) -> DataFrame:
    """(doc_id, source, size, source_size, target, shard, first, blocks, quota)
    per row: where the document stands in its shard's stream of words, and
    how many of the shard's blocks are given."""
    sizes = saved(docs.select("doc_id", "source", word_count().alias("size")))
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    aimed = targets(per_source, weights, max_repeats).withColumn(
        "shards", F.greatest(F.ceil(F.col("source_size") / shard_words), F.lit(1)).cast("long"))

    # documents in seeded order within their shards, as ranges of a word stream
    spread = (
        join_null_safe(sizes, aimed, ["source"])
        .withColumn("shard", F.pmod(seeded(seed, F.col("doc_id")), F.col("shards")))
        .withColumn("place", seeded(seed + 1, F.col("doc_id"), F.col("size")))
    )
    in_shard = W.partitionBy("source", "shard").orderBy("place", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    placed = spread.withColumn("first", F.coalesce(F.sum("size").over(in_shard), F.lit(0)))

    shards = spread.groupBy("source", "shard").agg(
        F.sum("size").alias("shard_size"), F.first("target").alias("target"), F.first("total").alias("total"))
    shards = shards.withColumn("blocks", F.ceil(F.col("shard_size") / block_words).cast("long"))
    by_source = shards.groupBy("source").agg(
        F.first("target").alias("vote"), F.first("total").alias("total"),
        (F.sum("blocks") * max_repeats).alias("most"))
    by_source = by_source.withColumn("seats", F.round(F.col("total") / block_words).cast("long"))
    quota = apportion(by_source, [], "source", "seats", "most").select("source", F.col("quota").alias("source_quota"))

    voted = join_null_safe(shards, quota, ["source"]).select(
        "source", "shard", "blocks", "source_quota", F.col("shard_size").cast("double").alias("vote"),
        (F.col("blocks") * max_repeats).alias("most"))
    shard_quota = apportion(voted, ["source"], "shard", "source_quota", "most").select("source", "shard", "blocks", "quota")
    return join_null_safe(placed, shard_quota, ["source", "shard"]).select(
        "doc_id", "source", "size", "source_size", "target", "shard", "first", "blocks", "quota")


def word_count() -> Column:
    return F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")


def _blocks(of: dict[str, Column], block_words: int, seed: int) -> Column:
    """The document's range cut by its shard's blocks, those with copies.

    The ``quota % blocks`` blocks that are given once more are every
    blocks / rest-th one from a seeded start: as documents stand in seeded
    order, a systematic choice of them is a seeded choice of text.
    """
    n = F.greatest(of["blocks"], F.lit(1))  # a shard of empty texts has none
    rest, every = of["quota"] % n, F.floor(of["quota"] / n).cast("long")
    turn = F.pmod(seeded(seed + 2, of["source"], of["shard"]), n)
    b, first, end = F.lit(block_words), of["first"], of["first"] + of["size"]

    def piece(j: Column) -> Column:
        place = F.pmod(j + turn, n)
        more = F.floor((place + 1) * rest / n) - F.floor(place * rest / n)
        return F.struct(
            (F.greatest(j * b, first) - first).alias("start"),
            (F.least((j + 1) * b, end) - first).alias("end"),
            (every + more).cast("long").alias("copies"))

    ids = F.sequence(F.floor(first / b), F.floor((end - 1) / b))
    none = F.array().cast("array<struct<start:bigint,end:bigint,copies:bigint>>")
    return F.when(of["size"] > 0, F.filter(F.transform(ids, piece), lambda p: p["copies"] > 0)).otherwise(none)


def _words_of(blocks: str) -> Column:
    return F.aggregate(blocks, F.lit(0).cast("long"), lambda acc, p: acc + (p["end"] - p["start"]) * p["copies"])


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, blocks, taken) per row.

    ``blocks`` lists the word ranges of the document that the mix takes, as
    (start, end, copies); ``taken`` is their words, copies counted.
    """
    chosen = _chosen(docs, weights, max_repeats, block_words, shard_words, seed)
    cut = chosen.withColumn("blocks", _blocks({c: F.col(c) for c in chosen.columns}, block_words, seed))
    return cut.withColumn("taken", _words_of("blocks")).select(
        "doc_id", "source", "size", "source_size", "target", "blocks", "taken")


def mixed_documents(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """``docs`` rows of which the mix takes something, with ``size``,
    ``source_size``, ``target``, ``blocks`` and ``taken`` beside their columns
    (input columns of those names are replaced).  The texts stay where they
    are while the documents' places in the shards are few."""
    added = ["size", "source_size", "target", "blocks", "taken"]
    kept = [c for c in docs.columns if c.lower() not in added]
    chosen = _chosen(docs, weights, max_repeats, block_words, shard_words, seed)
    names = {c: scratch_name(f"mix_{c}", docs.columns) for c in chosen.columns}
    # rows with equal id, source and size stand for each other
    places = saved(chosen.dropDuplicates(["doc_id", "source", "size"])).withColumnsRenamed(names)
    counted = scratch_name("mix_words", docs.columns)
    on = F.col(counted) == F.col(names["size"])
    for c in ("doc_id", "source"):
        on = on & F.col(c).eqNullSafe(F.col(names[c]))
    joined = docs.withColumn(counted, word_count()).join(small(places), on)
    of = {c: F.col(n) for c, n in names.items()}
    out = joined.select(
        *kept, *(of[c].alias(c) for c in ("size", "source_size", "target")), _blocks(of, block_words, seed).alias("blocks"))
    return out.withColumn("taken", _words_of("blocks")).where("taken > 0")
