"""Exact median and statistics of an INT column in one lazy plan.

Spark's ``percentile`` keeps a value->count map per group and merges all maps
in one final task; for a global median that task holds every distinct value.
Here the values are counted first (``groupBy(value).count()``, map-side
combined), and the middle rank is found in three levels of buckets of that
table: the top 11 bits, the next 11, the last 10.  Each level is a grouped sum
of at most 2,048 rows per wanted bucket, a running sum over those rows, and the
one or two buckets that hold the middle go on to the next level as a broadcast
of at most two rows.  Nothing is collected and nothing runs until the result
is asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Low bits left after each level of the 32-bit range.
LEVELS = (21, 10, 0)
INT_MIN = -(2**31)


def value_counts(df: DataFrame, value: Column) -> DataFrame:
    """(value int, n bigint) of the values that are not NULL."""
    return df.select(value.alias("value")).where(F.col("value").isNotNull()).groupBy("value").agg(F.count(F.lit(1)).alias("n"))


def middle_values(counts: DataFrame) -> DataFrame:
    """The one or two rows (value, first, last) of ``counts`` that hold the
    lower and the upper middle rank; none for an empty table.  ``first`` says
    that the row holds the lower, ``last`` that it holds the upper."""
    placed = counts.select((F.col("value").cast("bigint") - F.lit(INT_MIN)).alias("place"), "n")
    total = counts.agg(F.sum("n")).scalar()
    lower, upper = F.floor((total - 1) / 2), F.ceil((total - 1) / 2)
    held = None
    for bits in LEVELS:
        bucket = F.shiftright("place", bits)
        if held is None:
            level = placed.groupBy(bucket.alias("bucket")).agg(F.sum("n").alias("n")).withColumn("before", F.lit(0).cast("bigint"))
            running = Window.orderBy("bucket")
        else:
            inside = placed.withColumn("parent", F.shiftright("place", above)).join(F.broadcast(held), "parent")
            level = inside.groupBy("parent", "before", bucket.alias("bucket")).agg(F.sum("n").alias("n"))
            running = Window.partitionBy("parent").orderBy("bucket")
        upto = F.col("before") + F.sum("n").over(running)
        marked = level.withColumn("upto", upto).withColumn("start", F.col("upto") - F.col("n"))
        has_lower = (F.col("start") <= lower) & (lower < F.col("upto"))
        has_upper = (F.col("start") <= upper) & (upper < F.col("upto"))
        kept = marked.withColumn("first", has_lower).withColumn("last", has_upper).where("first or last")
        held = kept.select(F.col("bucket").alias("parent"), F.col("start").alias("before"))
        above = bits
    return kept.select((F.col("bucket") + F.lit(INT_MIN)).cast("int").alias("value"), "first", "last")


def median(counts: DataFrame) -> DataFrame:
    """One row: the exact median of the counted values as DOUBLE, the mean of
    the two middle values; NULL without values."""
    low = F.min(F.when(F.col("first"), F.col("value").cast("double")))
    high = F.max(F.when(F.col("last"), F.col("value").cast("double")))
    return middle_values(counts).agg((low + (high - low) * 0.5).alias("median"))


def statistics(counts: DataFrame) -> DataFrame:
    """One row: total, maximum, minimum and mean of the counted values."""
    total = F.sum(F.col("value").cast("bigint") * F.col("n"))
    return counts.agg(
        total.alias("total"), F.max("value").alias("maximum"), F.min("value").alias("minimum"),
        (total.cast("double") / F.sum("n")).alias("mean"))
