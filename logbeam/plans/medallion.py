"""The Bronze -> Silver -> Gold job (L1-L3, K5).

One text scan: Bronze is written once and re-read (Parquet, column-pruned)
for Silver; Silver is written partitioned by ``date`` and re-read for Gold,
so the gold aggregates scan only the Silver columns they use and never
re-run the regexes.  The written layers also cut the lineage: a lost
executor recomputes from the last written layer, not from the raw text.
Row counts come from ``observe()`` on the writes -- no extra ``count()`` job.
"""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor
from collections.abc import Mapping
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.formats import DEFAULT_FORMAT
from ..operators import gold, layers
from ..session import UTC, time_zone
from ..sources import files

log = logging.getLogger(__name__)

# JDBC table names for gold tables; others use gold_<name>.
GOLD_JDBC_TABLES = {
    "summary": "gold_summary_metrics",
    "top_ips": "gold_top_client_ips",
    "top_endpoints": "gold_top_endpoints",
    "peak_error": "gold_peak_error_day",
}


def layer_paths(output_path: str) -> dict[str, str]:
    base = output_path.rstrip("/")
    return {
        "bronze": f"{base}/bronze/logs.parquet",
        "silver": f"{base}/silver/logs.parquet",
        "gold": f"{base}/gold",
    }


def write_gold(tables: Mapping[str, DataFrame], gold_path: str | None = None, jdbc_url: str | None = None,
               jdbc_properties: Mapping[str, str] | None = None, parallel: int | None = None) -> dict[str, str]:
    """K5: each table to ``{gold_path}/{name}`` and, optionally, to JDBC.

    The tables are independent jobs over the same Silver, so they are
    submitted concurrently (Spark runs jobs from several threads side by
    side) instead of queueing behind each other.  With both targets JDBC is
    filled from the written Parquet, so each aggregate is computed once.  A
    JDBC table that fails is logged and skipped; a Parquet failure raises.
    Returns ``name -> error`` for the skipped JDBC tables.
    """

    def one(name: str, df: DataFrame) -> str | None:
        if gold_path:
            target = f"{gold_path.rstrip('/')}/{name}"
            files.write_parquet(df, target)
            df = files.read_parquet(df.sparkSession, target)
        if jdbc_url:
            table = GOLD_JDBC_TABLES.get(name, f"gold_{name}")
            try:
                files.write_jdbc(df, jdbc_url, table, properties=jdbc_properties)
            except Exception as exc:  # noqa: BLE001 - skip and continue, by contract
                log.warning("gold table %s not saved to JDBC: %s", name, exc)
                return str(exc)
        return None

    if not tables:
        return {}
    spark = next(iter(tables.values())).sparkSession
    # threads that carry the caller's job group and local properties
    carried = inheritable_thread_target(spark)(one)
    with ThreadPoolExecutor(max_workers=parallel or len(tables)) as pool:
        futures = {name: pool.submit(carried, name, df) for name, df in tables.items()}
        outcomes = {name: f.result() for name, f in futures.items()}
    return {name: err for name, err in outcomes.items() if err is not None}


def jdbc_driver_available(spark: SparkSession, properties: Mapping[str, str] | None = None) -> bool:
    """Whether the JDBC driver class named in ``properties`` can be loaded
    (no class named: left to the url, so assumed there)."""
    name = dict(properties or {}).get("driver")
    if not name:
        return True
    try:
        loader = spark.sparkContext._jvm.java.lang.Thread.currentThread().getContextClassLoader()
        spark.sparkContext._jvm.java.lang.Class.forName(name, False, loader)
        return True
    except Exception:  # noqa: BLE001 - whatever the loader says, it is not there
        return False


def analyze_logs(silver: DataFrame, output_path: str | None = None, jdbc_url: str | None = None,
                 jdbc_properties: Mapping[str, str] | None = None, top_n: int = gold.TOP_N,
                 view_name: str | None = "logs") -> dict[str, DataFrame]:
    """L2: register Silver as a temp view for ad-hoc SQL (Q1), build the Gold
    tables, and write them when ``output_path`` / ``jdbc_url`` is given.

    Returns name -> DataFrame (lazy when nothing is written; read back from
    the written Parquet otherwise, so later use does not recompute).
    """
    if view_name:
        silver.createOrReplaceTempView(view_name)
    tables = gold.gold_tables(silver, top_n)
    if not output_path and not jdbc_url:
        return tables
    write_gold(tables, output_path, jdbc_url, jdbc_properties)
    if not output_path:
        return tables
    spark = silver.sparkSession
    return {name: files.read_parquet(spark, f"{output_path.rstrip('/')}/{name}") for name in tables}


def run_medallion(spark: SparkSession, input_path: str, output_path: str, log_format: str | None = None,
                  jdbc_url: str | None = None, jdbc_properties: Mapping[str, str] | None = None,
                  top_n: int = gold.TOP_N, sample_size: int | None = None, spread_partitions: int | None = None,
                  rebalance: bool = True, tz: str | None = UTC) -> dict[str, Any]:
    """L1: parse ``input_path`` (text), write Bronze, Silver (by date) and Gold.

    ``sample_size`` limits format detection to the first lines,
    ``spread_partitions`` deals unsplittable input, ``rebalance=False`` skips
    the shuffle by date for time-ordered logs, ``tz`` is the zone of dates and
    hours (None: the session's).  A JDBC driver that cannot be loaded is found
    out once, before the tables are tried.

    Returns ``status, bronze_output, silver_output, gold_output,
    metrics_count, db_available, db_save_attempted, db_failures, rows,
    metrics`` (metrics: name -> DataFrame over the written Gold Parquet), or
    ``status='error'`` with ``error``.
    """
    paths = layer_paths(output_path)
    try:
        with time_zone(spark, tz):
            if sample_size and log_format in (None, "auto"):
                row = layers.detect_format(files.read_text(spark, input_path), sample_size).first()
                log_format = row["detected_format"] if row else DEFAULT_FORMAT
            _, bronze_rows = layers.write_bronze(spark, input_path, paths["bronze"], log_format, spread_partitions, tz=None)

            silver = layers.to_silver(files.read_parquet(spark, paths["bronze"]))
            silver_obs = Observation("silver")
            files.write_silver(silver.observe(silver_obs, F.count(F.lit(1)).alias("rows")), paths["silver"], rebalance=rebalance)

            silver_back = files.read_silver(spark, paths["silver"])
            silver_back.createOrReplaceTempView("logs")
            available = bool(jdbc_url) and jdbc_driver_available(spark, jdbc_properties)
            if jdbc_url and not available:
                log.warning("JDBC driver %r cannot be loaded; Gold goes to Parquet only", dict(jdbc_properties or {}).get("driver"))
            tables = gold.gold_tables(silver_back, top_n)
            failures = write_gold(tables, paths["gold"], jdbc_url if available else None, jdbc_properties)
            metrics = {name: files.read_parquet(spark, f"{paths['gold']}/{name}") for name in tables}
        return {
            "status": "success",
            "bronze_output": paths["bronze"],
            "silver_output": paths["silver"],
            "gold_output": paths["gold"],
            "metrics_count": len(metrics),
            "db_available": available,
            "db_save_attempted": available,
            "db_failures": failures,
            "rows": {"bronze": bronze_rows, "silver": silver_obs.get["rows"]},
            "metrics": metrics,
        }
    except Exception as exc:  # noqa: BLE001 - reported to the caller, by contract
        log.error("medallion run failed: %s", exc, exc_info=True)
        return {"status": "error", "error": str(exc)}


#: Gold tables cut to the first rows, and their order.
RANKED = {"top_ips": ("requests", "ip"), "top_endpoints": ("requests", "url")}


def gold_or_recompute(spark: SparkSession, name: str, gold_path: str | None, silver: DataFrame,
                      top_n: int = gold.TOP_N) -> DataFrame:
    """L3: the written Gold table when its write is finished, else the same
    aggregate recomputed from Silver.

    A ranked table answers for any ``top_n`` up to its own rows; when more are
    asked than it holds, it may have been cut shorter, so it is recomputed.
    """
    builders = {
        "summary": gold.summary,
        "top_ips": lambda s: gold.top_ips(s, top_n),
        "top_endpoints": lambda s: gold.top_endpoints(s, top_n),
        "error_analysis": gold.error_analysis,
        "peak_traffic": gold.peak_traffic,
        "peak_error": gold.peak_error,
        "summary_kv": gold.summary_kv,
    }
    if name not in builders:
        raise ValueError(f"unknown gold table {name!r}")
    path = f"{gold_path.rstrip('/')}/{name}" if gold_path else None
    if path and files.finished(spark, path):
        stored = files.read_parquet(spark, path)
        if name not in RANKED:
            return stored
        count, key = RANKED[name]
        if stored.limit(top_n).count() >= top_n:
            return stored.orderBy(F.desc(count), F.asc(key)).limit(top_n)
    return builders[name](silver)


def top_ips_answer(spark: SparkSession, gold_path: str | None, silver: DataFrame, top_n: int = gold.TOP_N) -> DataFrame:
    """R2: the top clients in the consumers' shape (``ip, count``): stored
    Gold with ``requests`` renamed, else recomputed."""
    table = gold_or_recompute(spark, "top_ips", gold_path, silver, top_n)
    return table.select("ip", F.col("requests").alias("count"))


def summary_metric_answer(spark: SparkSession, gold_path: str | None, silver: DataFrame, metric: str) -> DataFrame:
    """one metric from the stored key-value summary, else computed alone."""
    path = f"{gold_path.rstrip('/')}/summary_kv" if gold_path else None
    if path and files.finished(spark, path):
        return gold.metric_lookup(files.read_parquet(spark, path), metric)
    return gold.summary_metric(silver, metric)
