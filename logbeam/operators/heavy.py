"""Top-k by count with the light keys left out of the shuffle.

``gold.top_ips`` and the like shuffle a partial sum of every key of every
task, though ten keys are asked for.  Here the rows are counted in
``BUCKETS`` hash buckets first, a table of fixed size whatever the keys; a
bucket's count is an upper bound for each of its keys.  The keys of the
heaviest buckets are counted exactly, and their k-th largest count is a lower
bound for the k-th largest of all.  Only keys in buckets that reach it can be
among the first k (ties included), and only those are aggregated.

The rows are the same as without; what is saved is the shuffle of the other
keys, at the price of reading the key column three times.  So it pays on
stored, columnar input with far more keys than buckets of weight; where all
keys are alike nothing is left out and the result still holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 14
#: Heaviest buckets whose keys are counted for the bound, per wanted row.
TRIED_PER_ROW = 4


def _bucket(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS))


def possible(df: DataFrame, key: str, limit: int) -> DataFrame:
    """The rows of ``df`` whose key can be among the ``limit`` most frequent."""
    placed = df.select(key).withColumn("bucket", _bucket(key))
    sizes = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    tried = sizes.orderBy(F.desc("n"), "bucket").limit(limit * TRIED_PER_ROW).select("bucket")
    exact = placed.join(F.broadcast(tried), "bucket").groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    first = exact.orderBy(F.desc("n")).limit(limit)
    bound = first.agg(F.when(F.count(F.lit(1)) == limit, F.min("n")).otherwise(0)).scalar()
    # at most BUCKETS rows
    wanted = sizes.where(F.col("n") >= bound).select(F.col("bucket").alias("wanted_bucket"))
    return df.join(F.broadcast(wanted), _bucket(key) == F.col("wanted_bucket"), "left_semi")


def top(df: DataFrame, key: str, limit: int, aggregates: list[Column]) -> DataFrame:
    """``key, requests, *aggregates`` of the ``limit`` most frequent keys, ties
    by key."""
    return (
        possible(df, key, limit).groupBy(key).agg(F.count(F.lit(1)).alias("requests"), *aggregates)
        .orderBy(F.desc("requests"), F.asc(key)).limit(limit)
    )
