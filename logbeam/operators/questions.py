"""Traffic questions asked of the Silver layer.

Same rules as gold.py: map-side combined aggregates, deterministic top-k,
nothing collected.  The only joins are against bounded dimension rows (7
weekdays, ``bins`` histogram buckets), broadcast by construction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import enrich
from .gold import client_errors_by_weekday, sizes

HISTOGRAM_BINS = 50


def _top_count(df: DataFrame, key: str, limit: int, count_name: str = "count") -> DataFrame:
    return (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias(count_name))
        .orderBy(F.desc(count_name), F.asc(key))
        .limit(limit)
    )


def top_ips_by_count(silver: DataFrame, limit: int = 10) -> DataFrame:
    """A6 (Q1): ``ip, count``."""
    return _top_count(silver, "ip", limit)


def top_endpoints_excluding_files(silver: DataFrame, limit: int = 6) -> DataFrame:
    """A7 (Q2): urls that do not name a file (wider rule, query string
    allowed): ``url, count``."""
    return _top_count(silver.where(~enrich.is_file_url("url")), "url", limit)


def top_urls(silver: DataFrame, limit: int = 5) -> DataFrame:
    """Unfiltered ``url, requests``."""
    return _top_count(silver, "url", limit, "requests")


def distinct_ips(silver: DataFrame) -> DataFrame:
    """A9 (Q3)."""
    return silver.agg(F.count_distinct("ip").alias("distinct_ips"))


def day_count(silver: DataFrame) -> DataFrame:
    """A10 (Q4): days with at least one parsed timestamp."""
    return silver.agg(F.count_distinct("date").alias("day_count"))


def days_list(silver: DataFrame) -> DataFrame:
    """The distinct days, ascending; the missing day of unparsed lines is
    left out."""
    return silver.select("date").where(F.col("date").isNotNull()).distinct().orderBy("date")


def size_by_status_class(silver: DataFrame) -> DataFrame:
    """``category, requests, total_bytes, avg_bytes, max_bytes`` per
    status class, on the numeric size ('-' excluded)."""
    return (
        silver.select(enrich.status_class("status_int").alias("category"), enrich.size_bytes("size").alias("_size"))
        .groupBy("category")
        .agg(
            F.count(F.lit(1)).alias("requests"),
            F.sum("_size").alias("total_bytes"),
            F.avg("_size").alias("avg_bytes"),
            F.max("_size").alias("max_bytes"),
        )
        .orderBy("category")
    )


def size_histogram(silver: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Equal-width histogram of the numeric size over [min, max].

    Bin i (1-based) holds lo + (i-1)w <= x < lo + iw, the maximum goes to the
    last bin.  One count by size gives both the ends (scalar subqueries) and
    the counts by bin, left-joined to the ``bins`` bin numbers (broadcast, size
    fixed by the parameter) so empty bins show 0.  Output: ``bin, bin_lo,
    bin_hi, count``; without sizes every bin is empty and has no edges.
    """
    spark = silver.sparkSession
    counted = sizes(silver)
    ends = counted.agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    lo = ends.select(F.col("lo").cast("bigint")).scalar()
    width = ends.select((F.col("hi").cast("bigint") - F.col("lo")).cast("double")).scalar()
    offset = F.col("value").cast("bigint") - lo  # 64-bit: no overflow over the full INT range
    raw_bin = F.when(width == 0, F.lit(1)).otherwise(
        F.least(F.floor(F.try_divide(offset * F.lit(float(bins)), width)) + 1, F.lit(bins)))
    counts = counted.groupBy(raw_bin.cast("int").alias("bin")).agg(F.sum("n").alias("count"))
    all_bins = spark.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    edges = F.col("bin").cast("double")
    return (
        all_bins.join(F.broadcast(counts), "bin", "left")
        .select(
            "bin",
            (lo + width * (edges - 1) / bins).alias("bin_lo"),
            (lo + width * edges / bins).alias("bin_hi"),
            F.coalesce(F.col("count"), F.lit(0).cast("bigint")).alias("count"),
        )
        .orderBy("bin")
    )


def client_errors_all_weekdays(silver: DataFrame) -> DataFrame:
    """All seven weekdays, zero when a day has no 4xx responses."""
    spark = silver.sparkSession
    counts = client_errors_by_weekday(silver).select("day_of_week", "count")
    days = spark.range(1, 8).select(F.col("id").cast("int").alias("day_of_week"))
    return (
        days.join(F.broadcast(counts), "day_of_week", "left")
        .select(
            "day_of_week",
            enrich.weekday_name("day_of_week").alias("weekday_name"),
            F.coalesce(F.col("count"), F.lit(0).cast("bigint")).alias("count"),
        )
        .orderBy("day_of_week")
    )


def status_distribution(silver: DataFrame) -> DataFrame:
    """``status_int, count`` ascending (NULL = unparsed lines)."""
    return silver.groupBy("status_int").count().orderBy(F.asc_nulls_first("status_int"))


def total_errors(silver: DataFrame) -> DataFrame:
    """``sum((status >= 400)::int)`` -- NULL, not 0, when no row
    has a status."""
    return silver.agg(F.sum(enrich.is_error("status_int")).alias("total_errors"))


def layer_counts(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """Rows of the stored Bronze and Silver layers, the Bronze lines the
    pattern did not match, and the Silver rows without a timestamp.  Output:
    ``layer, rows``."""
    raw = bronze.agg(F.count(F.lit(1)).alias("bronze"), F.count_if(F.col("ip") == "").alias("unparsed"))
    typed = silver.agg(F.count(F.lit(1)).alias("silver"), F.count_if(F.col("parsed_timestamp").isNull()).alias("no_timestamp"))
    parts = [wide.unpivot([], wide.columns, "layer", "rows") for wide in (raw, typed)]
    return parts[0].unionByName(parts[1])
