"""Gold aggregates.

Every aggregate is a hash aggregate with a map-side partial step, so a hot
key (one client address or url with a third of all rows) is collapsed in
each task before the shuffle.  Top-k is ``orderBy(...).limit(k)``, which
Catalyst plans as ``TakeOrderedAndProject`` (per-task top-k, then a k-way
merge); ties are broken by the key so the result is deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import enrich
from . import states
from .quantile import median, statistics, value_counts

TOP_N = 10


def _errors() -> F.Column:
    return F.sum(enrich.is_error("status_int"))


def summary(silver: DataFrame) -> DataFrame:
    """A1: one wide row.  ``error_rate`` is a percentage over all rows,
    malformed ones included; NULL on empty input.  Counted per (date, ip)
    first, so two distinct counts cost no expanded rows."""
    return states.summary(states.client_days(silver))


def top_ips(silver: DataFrame, limit: int = TOP_N) -> DataFrame:
    """A2: ``ip, requests, total_bytes, errors``."""
    return (
        silver.groupBy("ip")
        .agg(F.count(F.lit(1)).alias("requests"), F.sum("bytes_sent_int").alias("total_bytes"), _errors().alias("errors"))
        .orderBy(F.desc("requests"), F.asc("ip"))
        .limit(limit)
    )


def top_endpoints(silver: DataFrame, limit: int = TOP_N) -> DataFrame:
    """A3: non-static urls; ``url, requests, avg_size, errors``."""
    return (
        silver.where(~F.col("is_static_asset"))
        .groupBy("url")
        .agg(F.count(F.lit(1)).alias("requests"), F.avg("bytes_sent_int").alias("avg_size"), _errors().alias("errors"))
        .orderBy(F.desc("requests"), F.asc("url"))
        .limit(limit)
    )


def error_analysis(silver: DataFrame) -> DataFrame:
    """A4: per error status, ``count, affected_users, affected_days``."""
    return states.error_analysis(states.error_days(silver))


def peak_traffic(silver: DataFrame) -> DataFrame:
    """A5: per (date, hour), busiest first."""
    return (
        silver.groupBy("date", "hour")
        .agg(F.count(F.lit(1)).alias("requests"), F.sum("bytes_sent_int").alias("total_bytes"), _errors().alias("errors"))
        .orderBy(F.desc("requests"), F.asc("date"), F.asc("hour"))
    )


def client_errors_by_weekday(silver: DataFrame) -> DataFrame:
    """4xx responses per weekday (1 = Sunday) with the weekday name."""
    counts = silver.where(enrich.is_client_error("status_int")).groupBy("day_of_week").count()
    return counts.select("day_of_week", enrich.weekday_name("day_of_week").alias("weekday_name"), "count").orderBy(
        "day_of_week"
    )


def peak_error(silver: DataFrame) -> DataFrame:
    """Weekday with the most 4xx responses: ``day_name, error_count``
    (earliest weekday wins a tie)."""
    return (
        client_errors_by_weekday(silver)
        .where(F.col("day_of_week").isNotNull())
        .orderBy(F.desc("count"), F.asc("day_of_week"))
        .limit(1)
        .select(F.col("weekday_name").alias("day_name"), F.col("count").alias("error_count"))
    )


def sizes(silver: DataFrame, size_col: str = "size") -> DataFrame:
    """(value, n): how often each numeric size occurs ('-' excluded)."""
    return value_counts(silver, enrich.size_bytes(size_col))


def size_stats(silver: DataFrame, size_col: str = "size", approximate: bool = False) -> DataFrame:
    """``total_bytes, max_bytes, min_bytes, avg_bytes, median_bytes`` on
    the numeric size ('-' excluded), all from one count by size.
    ``approximate`` takes the median from a sketch (``states.sketch_days``)
    instead of counting every size."""
    if approximate:
        return states.approximate_size_stats(states.sketch_days(silver, size_col))
    counts = sizes(silver, size_col)
    st = statistics(counts)
    return st.select(
        F.col("total").alias("total_bytes"), F.col("maximum").alias("max_bytes"), F.col("minimum").alias("min_bytes"),
        F.col("mean").alias("avg_bytes"), median(counts).scalar().alias("median_bytes"))


# Metric names of the key-value summary, as read by consumers.
SUMMARY_METRICS = [
    "total_requests",
    "unique_visitors",
    "distinct_client_ips",
    "days_span",
    "avg_response_size",
    "total_errors",
    "error_rate",
    "total_data_volume_bytes",
    "max_bytes",
    "min_bytes",
    "median_bytes",
]


# What each metric is made of: an aggregate of Silver, or of the count by size.
_TRAFFIC = {
    "total_requests": lambda: F.count(F.lit(1)),
    "unique_visitors": lambda: F.count_distinct("ip"),
    "distinct_client_ips": lambda: F.count_distinct("ip"),
    "days_span": lambda: F.count_distinct("date"),
    "avg_response_size": lambda: F.avg("bytes_sent_int"),
    "total_errors": _errors,
    "error_rate": lambda: _errors() / F.count(F.lit(1)) * 100,
}
_SIZES = {"total_data_volume_bytes": "total", "max_bytes": "maximum", "min_bytes": "minimum"}


def _as_rows(wide: DataFrame) -> DataFrame:
    """One wide row as ``metric_name, metric_value`` rows."""
    doubles = wide.select(*(F.col(c).cast("double").alias(c) for c in wide.columns))
    return doubles.unpivot([], doubles.columns, "metric_name", "metric_value")


def summary_metric(silver: DataFrame, metric: str) -> DataFrame:
    """One metric of the key-value summary, computing nothing else."""
    if metric in _TRAFFIC:
        return _as_rows(silver.agg(_TRAFFIC[metric]().alias(metric)))
    if metric in _SIZES:
        return _as_rows(statistics(sizes(silver)).select(F.col(_SIZES[metric]).alias(metric)))
    if metric == "median_bytes":
        return _as_rows(median(sizes(silver)).withColumnRenamed("median", metric))
    raise ValueError(f"unknown metric {metric!r}; known: {SUMMARY_METRICS}")


def summary_kv(silver: DataFrame) -> DataFrame:
    """A1 + A12 as ``metric_name STRING, metric_value DOUBLE`` rows: the
    summary of Silver and the count by size."""
    return key_values(summary(silver), sizes(silver))


def key_values(wide: DataFrame, counts: DataFrame) -> DataFrame:
    """R1 from the summary row and the count by size."""
    traffic = _as_rows(wide.withColumn("distinct_client_ips", F.col("unique_visitors")))
    volume = _as_rows(statistics(counts).select(*(F.col(c).alias(m) for m, c in _SIZES.items())))
    middle = _as_rows(median(counts).withColumnRenamed("median", "median_bytes"))
    return traffic.union(volume).union(middle)


def metric_lookup(kv: DataFrame, metric: str) -> DataFrame:
    """one metric by name from the (stored) key-value summary."""
    return kv.where(F.col("metric_name") == metric)


def gold_tables(silver: DataFrame, top_n: int = TOP_N) -> dict[str, DataFrame]:
    """L2: the Gold tables by name."""
    return {
        "summary": summary(silver),
        "top_ips": top_ips(silver, top_n),
        "top_endpoints": top_endpoints(silver, top_n),
        "error_analysis": error_analysis(silver),
        "peak_traffic": peak_traffic(silver),
        "peak_error": peak_error(silver),
        "summary_kv": summary_kv(silver),
    }
