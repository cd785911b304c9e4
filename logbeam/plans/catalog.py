"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Every query starts from the ``events`` table of ``sf_dir``, renders it as
access-log lines (one projection), parses and enriches them, and runs one
operator over the whole input.  Queries that exercise a sink write under the
shared ``spark.checkpoint.dir`` (a fresh folder per call, deleted when the
driver ends) and read back; the others start no job until their result is
asked for.  Plans are built in UTC and the session keeps its own zone.
Timestamps are returned as ``yyyy-MM-dd HH:mm:ss`` strings (UTC) so results
compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.formats import (
    APACHE_COMBINED,
    APACHE_COMMON,
    CLF_TIMESTAMP,
    NGINX,
    LogFormat,
    register_format,
    unregister_format,
)
from ..operators import gold, heavy, layers, questions, states
from ..session import in_utc, temporary_path
from ..sources import files
from ..sources.fixture import access_log_lines, lines_from_tables, read_events
from ..streaming import traffic
from . import daily, medallion

Query = Callable[[SparkSession, str], DataFrame]

# A caller-defined format (P3) -- just the quoted request line.
REQUEST_LINE = LogFormat("request_line", r'"(\S+) (\S+) (\S+)"', ("method", "url", "protocol"))
# A caller-defined format longer than the combined one it starts with.
TIMED = LogFormat("combined_timed", APACHE_COMBINED.pattern + r" (\d+)$", (*APACHE_COMBINED.columns, "millis"), CLF_TIMESTAMP)
HEADER_LINES = 20
# Date range read by the partition-pruning query.
PRUNE_FROM, PRUNE_TO = "2024-01-10", "2024-01-12"
ROUNDTRIP_FORMATS = ["csv", "json", "orc", "parquet"]
STREAM_FILES = 6
# Dates whose Silver is replaced by a second load.
REPLACED = ("2024-01-05", "2024-01-20")
PROBABILITIES = [0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99]
# Every 40th event comes late; the stream lands in so many parts by time.
LATE_EVERY, LATE_REST, SLICES = 40, 5, 3
WATERMARK = "1 hour"


def render_ts(df: DataFrame, column: str = "parsed_timestamp") -> DataFrame:
    if column not in df.columns:
        return df
    return df.withColumn(column, F.date_format(column, traffic.TS_FORMAT))


def lines(spark: SparkSession, sf_dir: str, flavor: str = "combined") -> DataFrame:
    return lines_from_tables(spark, sf_dir, flavor)


def bronze(spark: SparkSession, sf_dir: str, flavor: str = "combined", fmt: str | LogFormat = APACHE_COMBINED) -> DataFrame:
    return layers.to_bronze(lines(spark, sf_dir, flavor), fmt)


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers.to_silver(bronze(spark, sf_dir))


def _on_silver(op: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: op(silver(spark, sf_dir))


def _stage_text(spark: SparkSession, sf_dir: str, name: str, flavor: str = "combined", compression: str | None = None,
                parts: int | None = None) -> str:
    """Write the rendered lines as text files in the shared scratch folder;
    ``parts`` deals them to so many files, in no order of time."""
    path = temporary_path(spark, name)
    opts = {"compression": compression} if compression else None
    rendered = lines(spark, sf_dir, flavor)
    files.write(rendered.repartition(parts, F.xxhash64("value")) if parts else rendered, path, "text", options=opts)
    return path


# ------------------------------------------------------------- phase 1-2
def q_parse_common(spark, sf_dir):
    return render_ts(bronze(spark, sf_dir, "common", APACHE_COMMON))


def q_silver_types(spark, sf_dir):
    return silver(spark, sf_dir).select("value", "status", "size", "status_int", "bytes_sent_int")


def q_silver_static(spark, sf_dir):
    return silver(spark, sf_dir).select("value", "url", "file_extension", "is_static_asset")


def q_silver_time(spark, sf_dir):
    return render_ts(silver(spark, sf_dir).select("value", "parsed_timestamp", "day_of_week", "date", "hour", "minute"))


def q_silver_logs(spark, sf_dir):
    return render_ts(silver(spark, sf_dir))


# ------------------------------------------------------------- phase 3
def q_summary_metric_lookup(spark, sf_dir):
    return gold.summary_metric(silver(spark, sf_dir), "distinct_client_ips")


def q_layer_counts(spark, sf_dir):
    base = temporary_path(spark, "layers")
    files.write_parquet(bronze(spark, sf_dir), f"{base}/bronze")
    stored = files.read_parquet(spark, f"{base}/bronze")
    files.write_silver(layers.to_silver(stored), f"{base}/silver")
    return questions.layer_counts(stored, files.read_silver(spark, f"{base}/silver"))


# ------------------------------------------------------------- phase 5
def q_parse_combined(spark, sf_dir):
    return render_ts(bronze(spark, sf_dir, "combined", APACHE_COMBINED))


def q_parse_nginx(spark, sf_dir):
    return render_ts(bronze(spark, sf_dir, "nginx", NGINX))


def q_parse_custom(spark, sf_dir):
    register_format(REQUEST_LINE, detectable=False)
    try:
        return bronze(spark, sf_dir, "combined", REQUEST_LINE.name)
    finally:
        unregister_format(REQUEST_LINE.name)


def q_detect_format(spark, sf_dir):
    return layers.detect_format(lines(spark, sf_dir, "combined"))


def q_detect_longer_format(spark, sf_dir):
    """Header lines first, then lines of a registered format that starts with
    a shorter one."""
    header = spark.range(HEADER_LINES).select(F.concat(F.lit("# header "), F.col("id").cast("string")).alias("value"))
    register_format(TIMED)
    try:
        return layers.detect_format(header.union(lines(spark, sf_dir, "timed")))
    finally:
        unregister_format(TIMED.name)


# ------------------------------------------------------------- phase 6
def q_src_text(spark, sf_dir):
    path = _stage_text(spark, sf_dir, "src-text", compression="gzip")
    return files.read_text(spark, path)


def q_src_formats_roundtrip(spark, sf_dir):
    df = silver(spark, sf_dir).select("ip", "url", "status_int", "bytes_sent_int", "date")
    schema = "ip string, url string, status_int int, bytes_sent_int int, date string"
    base = temporary_path(spark, "formats")
    parts = []
    for fmt in ROUNDTRIP_FORMATS:
        # CSV: a distinct NULL marker keeps '' and NULL apart on the way back.
        opts = {"header": "true", "nullValue": "\\N"} if fmt == "csv" else None
        files.write(df, f"{base}/{fmt}", fmt, options=opts)
        back = files.read(spark, f"{base}/{fmt}", fmt, options=opts, schema=schema)
        parts.append(back.select(F.lit(fmt).alias("format"), *df.columns))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_bronze_roundtrip(spark, sf_dir):
    path = temporary_path(spark, "bronze")
    files.write_parquet(bronze(spark, sf_dir), path)
    return render_ts(files.read_parquet(spark, path))


def q_append_roundtrip(spark, sf_dir):
    path = temporary_path(spark, "append")
    b = bronze(spark, sf_dir)
    files.write_parquet(b, path, mode="overwrite")
    files.write_parquet(b, path, mode="append")
    return files.read_parquet(spark, path).groupBy("status").agg(F.count(F.lit(1)).alias("rows"))


def q_silver_partition_pruned(spark, sf_dir):
    path = temporary_path(spark, "silver")
    files.write_silver(silver(spark, sf_dir), path)
    s = files.read_silver(spark, path).where(F.col("date").between(PRUNE_FROM, PRUNE_TO))
    return s.groupBy("date", "hour").agg(
        F.count(F.lit(1)).alias("requests"), F.sum("bytes_sent_int").alias("total_bytes")
    )


def q_sql_view_logs(spark, sf_dir):
    silver(spark, sf_dir).createOrReplaceTempView("logs")
    return spark.sql(
        "SELECT method, count(*) AS requests, sum(bytes_sent_int) AS total_bytes, "
        "count(DISTINCT ip) AS clients FROM logs GROUP BY method"
    )


# ------------------------------------------------------------- phase 7
# How each Gold table fits the tagged union: keys, whole numbers, doubles.
GOLD_SHAPES: dict[str, tuple[list[str], list[str], list[str]]] = {
    "summary": ([], ["total_requests", "unique_visitors", "days_span", "total_errors"], ["avg_response_size", "error_rate"]),
    "top_ips": (["ip"], ["requests", "total_bytes", "errors"], []),
    "top_endpoints": (["url"], ["requests", "errors"], ["avg_size"]),
    "error_analysis": (["status"], ["status_int", "count", "affected_users", "affected_days"], []),
    "peak_traffic": (["date", "hour"], ["requests", "total_bytes", "errors"], []),
    "peak_error": (["day_name"], ["error_count"], []),
    "summary_kv": (["metric_name"], [], ["metric_value"]),
}
GOLD_WIDTHS = (("k", 2, "string"), ("n", 4, "bigint"), ("x", 2, "double"))


def tagged_union(tables: Mapping[str, DataFrame]) -> DataFrame:
    """All Gold tables as rows ``gold_table, k1-k2, n1-n4, x1-x2``."""
    out = None
    for name, shape in GOLD_SHAPES.items():
        columns = [F.lit(name).alias("gold_table")]
        for (letter, width, kind), own in zip(GOLD_WIDTHS, shape, strict=True):
            for i in range(width):
                value = F.col(own[i]) if i < len(own) else F.lit(None)
                columns.append(value.cast(kind).alias(f"{letter}{i + 1}"))
        rows = tables[name].select(*columns)
        out = rows if out is None else out.unionByName(rows)
    return out


def q_medallion_gold(spark, sf_dir):
    src = _stage_text(spark, sf_dir, "medallion-in")
    result = medallion.run_medallion(spark, src, temporary_path(spark, "medallion-out"), log_format="auto")
    if result["status"] != "success":
        raise RuntimeError(result["error"])
    return tagged_union(result["metrics"])


def q_gold_or_recompute(spark, sf_dir):
    missing = temporary_path(spark, "gold-missing")
    return medallion.gold_or_recompute(spark, "top_ips", missing, silver(spark, sf_dir))


def _stored_gold(spark, sf_dir) -> tuple[str, DataFrame]:
    s = silver(spark, sf_dir)
    path = temporary_path(spark, "gold-stored")
    tables = gold.gold_tables(s)
    medallion.write_gold({name: tables[name] for name in ("top_ips", "summary_kv")}, path)
    return path, s


def q_top_ips_from_gold(spark, sf_dir):
    path, s = _stored_gold(spark, sf_dir)
    return medallion.top_ips_answer(spark, path, s, 7)


def q_top_ips_beyond_gold(spark, sf_dir):
    """More rows than stored Gold holds: recomputed."""
    path, s = _stored_gold(spark, sf_dir)
    return medallion.top_ips_answer(spark, path, s, 25)


def q_metric_from_gold(spark, sf_dir):
    path, s = _stored_gold(spark, sf_dir)
    return medallion.summary_metric_answer(spark, path, s, "median_bytes")


# ------------------------------------------------------------- phase 8
def q_stream_silver(spark, sf_dir):
    src = _stage_text(spark, sf_dir, "stream-in")
    out = temporary_path(spark, "stream-silver")
    traffic.stream_silver(spark, src, out, temporary_path(spark, "stream-silver-ckpt"), APACHE_COMBINED)
    return render_ts(files.read_silver(spark, out))


def q_windowed_traffic_stream(spark, sf_dir):
    """Several micro-batches, one file each, over files in no order of time."""
    src = _stage_text(spark, sf_dir, "stream-win-in", parts=STREAM_FILES)
    out = temporary_path(spark, "stream-win")
    traffic.stream_windowed_traffic(spark, src, out, temporary_path(spark, "stream-win-ckpt"), APACHE_COMBINED, max_files_per_trigger=1)
    return traffic.read_windowed_traffic(spark, out)


# ------------------------------------------------------------- phase 9: states by date
def stored_silver(spark, sf_dir) -> str:
    path = temporary_path(spark, "silver-by-date")
    files.write_silver(silver(spark, sf_dir), path)
    return path


def daily_states(spark, sf_dir) -> daily.DailyStates:
    return daily.DailyStates(spark, stored_silver(spark, sf_dir), temporary_path(spark, "states"))


def q_gold_by_date(spark, sf_dir):
    """Every Gold table, with the states of every second date stored."""
    kept = daily_states(spark, sf_dir)
    half = sorted(daily.silver_dates(spark, kept.silver_path))[::2]
    for state in ("client_days", "endpoint_days", "error_days", "hour_days", "weekday_days", "size_days"):
        kept.refresh(state, half)
    return tagged_union({name: kept.answer(name) for name in GOLD_SHAPES})


def q_size_quantiles_by_sketch(spark, sf_dir):
    """Stored size sketches, merged, against the exact counts."""
    kept = daily_states(spark, sf_dir)
    kept.refresh("sketch_days")
    guess = states.approximate_quantiles(kept.table("sketch_days"), PROBABILITIES)
    off = states.rank_errors(guess, gold.sizes(files.read_silver(spark, kept.silver_path)))
    return off.select("probability", "values", (F.col("rank_error") <= states.KLL_ERROR).alias("within"))


def q_size_stats_by_sketch(spark, sf_dir):
    """The stored sketches' size statistics: the exact ones as they are."""
    kept = daily_states(spark, sf_dir)
    kept.refresh("sketch_days")
    return kept.answer("approximate_size_stats").select(
        "total_bytes", "max_bytes", "min_bytes", "avg_bytes", F.col("median_bytes").between(F.col("min_bytes"), F.col("max_bytes")).alias("median_inside"))


def q_summary_by_sketch(spark, sf_dir):
    """The summary from stored sketches; visitors checked against the exact count."""
    kept = daily_states(spark, sf_dir)
    kept.refresh("sketch_days")
    exact = questions.distinct_ips(files.read_silver(spark, kept.silver_path)).scalar()
    close = F.abs(F.col("unique_visitors") - exact) <= exact * states.HLL_ERROR
    return kept.answer("approximate_summary").withColumn("visitors_close", close).drop("unique_visitors")


def q_silver_dates_replaced(spark, sf_dir):
    """A second load replaces two dates; the others stay."""
    path = stored_silver(spark, sf_dir)
    again = silver(spark, sf_dir).where(F.col("date").isin(*REPLACED) & (F.col("status_int") < 400))
    files.write_silver(again, path, dynamic_overwrite=True)
    return files.read_silver(spark, path).groupBy("date", "status_int").agg(
        F.count(F.lit(1)).alias("requests"), F.sum("bytes_sent_int").alias("total_bytes"))


def _pruned_top(key: str, where: str = "true") -> Query:
    def build(spark, sf_dir):
        stored = files.read_silver(spark, stored_silver(spark, sf_dir)).where(where)
        sums = [F.sum("bytes_sent_int").alias("total_bytes"), F.sum((F.col("status_int") >= 400).cast("int")).alias("errors")]
        return heavy.top(stored, key, gold.TOP_N, sums)

    return build


def _land(spark, events: DataFrame, folder: str, name: str) -> None:
    files.write(access_log_lines(events, "combined"), f"{folder}/{name}", "text")


def _slices(spark, events: DataFrame) -> list[DataFrame]:
    """The events in ``SLICES`` parts by time, one after the other."""
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    if first is None:
        return [events]
    cuts = [first + (last - first) * i / SLICES for i in range(1, SLICES)]
    place = F.lit(0)
    for cut in cuts:
        place = place + (F.col("ts") >= F.lit(cut).cast("timestamp_ntz")).cast("int")
    return [events.where(place == i) for i in range(SLICES)]


def q_final_windows_stream(spark, sf_dir):
    """Windows emitted once, over runs that go on from one checkpoint, the
    last of which brings rows that are late for most windows."""
    events = read_events(spark, sf_dir)
    late = F.pmod("event_id", F.lit(LATE_EVERY)) == LATE_REST
    src, out, ckpt = (temporary_path(spark, f"final-{n}") for n in ("in", "out", "ckpt"))
    runs = []
    for i, part in enumerate([*_slices(spark, events.where(~late)), events.where(late)]):
        _land(spark, part, src, f"part-{i}")
        runs.append(traffic.stream_final_windows(spark, f"{src}/*", out, ckpt, APACHE_COMBINED, watermark=WATERMARK))
    final, still = traffic.final_windows(spark, out), traffic.open_windows(spark, ckpt)
    both = final.withColumn("final", F.lit(True)).unionAll(still.withColumn("final", F.lit(False)))
    return both.withColumn("late_rows", traffic.late_rows(runs, final, still).scalar())


def q_threshold_windows_stream(spark, sf_dir):
    """Alerts decided on finished windows; a last line of a later hour closes
    the windows before it."""
    events = read_events(spark, sf_dir)
    src, out, ckpt = (temporary_path(spark, f"alerts-{n}") for n in ("in", "out", "ckpt"))
    later = events.agg(F.max("ts").alias("ts")).select(
        F.lit(0).cast("bigint").alias("event_id"), (F.col("ts") + F.expr("INTERVAL 3 HOURS")).alias("ts"), F.lit(0).cast("bigint").alias("user_id"),
        F.lit("view").alias("event_type"), F.lit(0.0).alias("value"))
    for i, part in enumerate([*_slices(spark, events), later]):
        _land(spark, part, src, f"part-{i}")
        traffic.stream_final_windows(
            spark, f"{src}/*", out, ckpt, APACHE_COMBINED, watermark=WATERMARK, threshold=traffic.ERROR_THRESHOLD)
    return traffic.final_windows(spark, out)


def queries() -> dict[str, Query]:
    found = {
        # phase 1-2: parse + Silver
        "parse_common": q_parse_common,
        "silver_types": q_silver_types,
        "silver_static": q_silver_static,
        "silver_time": q_silver_time,
        "silver_logs": q_silver_logs,
        # phase 3: Gold
        "gold_summary": _on_silver(gold.summary),
        "gold_top_ips": _on_silver(gold.top_ips),
        "gold_top_endpoints": _on_silver(gold.top_endpoints),
        "gold_error_analysis": _on_silver(gold.error_analysis),
        "gold_peak_traffic": _on_silver(gold.peak_traffic),
        "gold_peak_error": _on_silver(gold.peak_error),
        "summary_kv": _on_silver(gold.summary_kv),
        "summary_metric_lookup": q_summary_metric_lookup,
        # phase 4: notebook questions
        "top10_ips": _on_silver(questions.top_ips_by_count),
        "top6_endpoints": _on_silver(questions.top_endpoints_excluding_files),
        "top5_urls": _on_silver(questions.top_urls),
        "distinct_ips": _on_silver(questions.distinct_ips),
        "day_count": _on_silver(questions.day_count),
        "days_list": _on_silver(questions.days_list),
        "size_stats": _on_silver(gold.size_stats),
        "size_by_status_class": _on_silver(questions.size_by_status_class),
        "size_histogram": _on_silver(questions.size_histogram),
        "client_errors_by_weekday": _on_silver(gold.client_errors_by_weekday),
        "client_errors_all_weekdays": _on_silver(questions.client_errors_all_weekdays),
        "status_distribution": _on_silver(questions.status_distribution),
        "layer_counts": q_layer_counts,
        "total_errors": _on_silver(questions.total_errors),
        # phase 5: formats
        "parse_combined": q_parse_combined,
        "parse_custom": q_parse_custom,
        "detect_format": q_detect_format,
        "detect_longer_format": q_detect_longer_format,
        "parse_nginx": q_parse_nginx,
        # phase 6: sources, sinks, SQL
        "src_text": q_src_text,
        "src_formats_roundtrip": q_src_formats_roundtrip,
        "bronze_roundtrip": q_bronze_roundtrip,
        "append_roundtrip": q_append_roundtrip,
        "silver_partition_pruned": q_silver_partition_pruned,
        "sql_view_logs": q_sql_view_logs,
        # phase 7: the Bronze -> Silver -> Gold job
        "medallion_gold": q_medallion_gold,
        "gold_or_recompute": q_gold_or_recompute,
        "top_ips_from_gold": q_top_ips_from_gold,
        "top_ips_beyond_gold": q_top_ips_beyond_gold,
        "metric_from_gold": q_metric_from_gold,
        # phase 8: streaming and windows
        "stream_silver": q_stream_silver,
        "windowed_traffic": _on_silver(traffic.windowed_traffic),
        "error_threshold_windows": _on_silver(traffic.error_threshold_windows),
        "windowed_traffic_stream": q_windowed_traffic_stream,
        # phase 9: states by date, sketches, heavy keys, windows emitted once
        "gold_by_date": q_gold_by_date,
        "size_quantiles_by_sketch": q_size_quantiles_by_sketch,
        "size_stats_by_sketch": q_size_stats_by_sketch,
        "summary_by_sketch": q_summary_by_sketch,
        "silver_dates_replaced": q_silver_dates_replaced,
        "heavy_top_ips": _pruned_top("ip"),
        "heavy_top_endpoints": _pruned_top("url", "not is_static_asset"),
        "final_windows_stream": q_final_windows_stream,
        "threshold_windows_stream": q_threshold_windows_stream,
    }
    return {name: in_utc(build) for name, build in found.items()}
