"""Streaming Silver (S2) and windowed traffic (D1, D2), batch and streaming.

Parsing and enrichment are pure column expressions, so the batch functions
run unchanged on a streaming DataFrame.  Streaming jobs keep their offsets
and aggregation state in a checkpoint under the shared
``spark.checkpoint.dir`` and write idempotently, so a lost executor or a
restarted driver resumes instead of double-counting.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import enrich
from ..functions.formats import DEFAULT_FORMAT, LogFormat
from ..operators.layers import to_bronze, to_silver
from ..session import UTC, settings, time_zone
from ..sources import files

# Analysis defaults (window length and error-ratio threshold).
WINDOW_MINUTES = 60
ERROR_THRESHOLD = 0.05
TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
# A state store on the executors' disks: state larger than their memory, and
# only changes are written to the checkpoint.
ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def _window_aggs() -> list:
    return [
        F.count(F.lit(1)).alias("requests"),
        F.sum(enrich.is_error("status_int")).alias("errors"),
        F.sum("bytes_sent_int").alias("total_bytes"),
    ]


def _window_select(df: DataFrame) -> DataFrame:
    return df.select(
        F.date_format("w.start", TS_FORMAT).alias("window_start"),
        F.date_format("w.end", TS_FORMAT).alias("window_end"),
        "requests",
        "errors",
        "total_bytes",
        (F.col("errors") / F.col("requests")).alias("error_ratio"),
    )


def windowed_traffic(silver: DataFrame, minutes: int = WINDOW_MINUTES) -> DataFrame:
    """Tumbling event-time windows (epoch aligned); rows without a parsed
    timestamp belong to no window.  ``window_start, window_end, requests,
    errors, total_bytes, error_ratio``."""
    w = F.window("parsed_timestamp", f"{minutes} minutes").alias("w")
    return _window_select(silver.groupBy(w).agg(*_window_aggs())).orderBy("window_start")


def error_threshold_windows(silver: DataFrame, threshold: float = ERROR_THRESHOLD,
                            minutes: int = WINDOW_MINUTES) -> DataFrame:
    """Windows whose error ratio exceeds ``threshold``."""
    return windowed_traffic(silver, minutes).where(F.col("error_ratio") > F.lit(threshold))


def stream_silver(spark: SparkSession, input_dir: str, output_path: str, checkpoint: str,
                  log_format: str | LogFormat = DEFAULT_FORMAT, max_files_per_trigger: int | None = None,
                  wait: bool = True, splits: int = files.DATE_SPLITS, tz: str | None = UTC):
    """S2 -> P -> E -> Parquet (partitioned by date), ``availableNow``: process
    every file present, then stop.  Each micro-batch is clustered by date, at
    most ``splits`` files per date and batch.  The file sink's metadata log
    makes the output exactly-once.  Returns the ``StreamingQuery``."""
    with time_zone(spark, tz):
        lines = files.read_text(spark, input_dir, streaming=True, max_files_per_trigger=max_files_per_trigger)
        silver = files.cluster(to_silver(to_bronze(lines, log_format)), [files.SILVER_PARTITION], splits)
        query = (
            silver.writeStream.format("parquet")
            .option("path", output_path)
            .option("checkpointLocation", checkpoint)
            .partitionBy(files.SILVER_PARTITION)
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
        )
    if wait:
        query.awaitTermination()
    return query


class WindowStream:
    """A running windowed-traffic query and the rows its watermark dropped."""

    def __init__(self) -> None:
        self.query = None
        self._dropped: dict[int, int] = {}

    def note(self) -> None:
        """Take in the progress reports so far (the query keeps only the last
        hundred, so every micro-batch calls this)."""
        for p in self.query.recentProgress if self.query is not None else ():
            self._dropped[p["batchId"]] = sum(op["numRowsDroppedByWatermark"] for op in p["stateOperators"])

    def dropped_rows(self) -> int:
        """Rows that came too late for the watermark and are in no window;
        always 0 without a watermark."""
        self.note()
        return sum(self._dropped.values())


def stream_windowed_traffic(spark: SparkSession, input_dir: str, output_path: str, checkpoint: str,
                            log_format: str | LogFormat = DEFAULT_FORMAT, minutes: int = WINDOW_MINUTES,
                            watermark: str | None = None, max_files_per_trigger: int | None = None,
                            wait: bool = True, tz: str | None = UTC) -> WindowStream:
    """D1 as a stateful streaming aggregation.

    By default nothing is ever too late: the state is one row per window, so
    it grows with the time span of the logs, not with their rows, and files
    may come in any order.  A caller whose stream never ends may pass a
    ``watermark`` to let old windows go; rows later than that are left out, and
    ``dropped_rows()`` of the result counts them.

    ``update`` mode emits every window touched by a micro-batch, and
    ``foreachBatch`` overwrites ``{output_path}/batch_id=N`` so a retried batch
    replaces its own output.  ``read_windowed_traffic`` keeps the newest
    version of each window, ``compact_windowed_traffic`` rewrites the batches
    as one.
    """
    out = WindowStream()
    with time_zone(spark, tz):
        lines = files.read_text(spark, input_dir, streaming=True, max_files_per_trigger=max_files_per_trigger)
        silver = to_silver(to_bronze(lines, log_format))
        if watermark:
            silver = silver.withWatermark("parsed_timestamp", watermark)
        w = F.window("parsed_timestamp", f"{minutes} minutes").alias("w")
        timed = silver.where(F.col("parsed_timestamp").isNotNull())
        agg = timed.groupBy(w).agg(*_window_aggs()).select("w.start", "w.end", "requests", "errors", "total_bytes")

        def sink(batch: DataFrame, batch_id: int) -> None:
            out.note()
            batch.write.mode("overwrite").parquet(f"{output_path.rstrip('/')}/batch_id={batch_id}")

        out.query = (
            agg.writeStream.outputMode("update")
            .foreachBatch(sink)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    if wait:
        out.query.awaitTermination()
        out.note()
    return out


def _latest(emitted: DataFrame) -> DataFrame:
    """Newest version of each window, by its instant (a clock that is set back
    gives two windows one wall-clock time)."""
    values = F.struct("end", "requests", "errors", "total_bytes")
    newest = emitted.groupBy("start").agg(F.max_by(values, "batch_id").alias("v"), F.max("batch_id").alias("batch_id"))
    return newest.select("start", "v.*", "batch_id")


def read_windowed_traffic(spark: SparkSession, output_path: str, tz: str | None = UTC) -> DataFrame:
    """Latest emitted version of every window, as ``windowed_traffic``
    returns it (partially aggregated by window: no task gathers them all)."""
    with time_zone(spark, tz):
        latest = _latest(spark.read.parquet(output_path))
        return _window_select(latest.withColumn("w", F.struct("start", "end"))).orderBy("window_start")


def compact_windowed_traffic(spark: SparkSession, output_path: str) -> None:
    """Rewrite the batches of a stopped stream as the last of them: readers
    then open one version of each window.  The merged batch is written aside
    (``_merged``) before any batch is touched; a run that breaks off can be
    finished from there."""
    base = output_path.rstrip("/")
    emitted = spark.read.parquet(base)
    last = emitted.agg(F.max("batch_id")).first()[0]
    if last is None:
        return
    merged = f"{base}/_merged"
    _latest(emitted).drop("batch_id").write.mode("overwrite").parquet(merged)
    batches = files.children(spark, base, "batch_id=")
    files.replace_path(spark, merged, f"{base}/batch_id={last}")
    for path in batches:
        if not path.endswith(f"/batch_id={last}"):
            files.delete_path(spark, path)


# ------------------------------------------------------- windows emitted once
class FinalWindows:
    """A running query that emits each window once, when it is final."""

    def __init__(self) -> None:
        self.query = None
        self._seen: dict[int, int] = {}

    def note(self) -> None:
        """Take in the progress reports so far (see ``WindowStream.note``)."""
        for p in self.query.recentProgress if self.query is not None else ():
            metrics = p["observedMetrics"]
            if "timed" in metrics:
                self._seen[p["batchId"]] = metrics["timed"]["rows"] or 0

    def timed_rows(self) -> int:
        """Rows with a timestamp that this run has read."""
        self.note()
        return sum(self._seen.values())


def stream_final_windows(spark: SparkSession, input_dir: str, output_path: str, checkpoint: str,
                         log_format: str | LogFormat = DEFAULT_FORMAT, minutes: int = WINDOW_MINUTES,
                         watermark: str = "1 hour", threshold: float | None = None,
                         max_files_per_trigger: int | None = None, wait: bool = True, tz: str | None = UTC) -> FinalWindows:
    """D1 in append mode: a window is emitted once, when the watermark (the
    latest timestamp less ``watermark``) has passed its end, and its state is
    let go; the state is the open windows only, kept in RocksDB.  Rows whose
    window is closed already are late and are in no window (``late_rows``).
    With ``threshold`` only windows whose error ratio exceeds it are emitted
    (D2): decided on finished windows, so an alert is never taken back.

    Processes the files present, then stops; the next run with the same
    checkpoint goes on from there.  Batches overwrite their own folder, so a
    retried batch emits nothing twice.
    """
    out = FinalWindows()
    with time_zone(spark, tz), settings(spark, ROCKSDB):
        lines = files.read_text(spark, input_dir, streaming=True, max_files_per_trigger=max_files_per_trigger)
        silver = to_silver(to_bronze(lines, log_format)).where(F.col("parsed_timestamp").isNotNull())
        timed = silver.observe("timed", F.count(F.lit(1)).alias("rows")).withWatermark("parsed_timestamp", watermark)
        w = F.window("parsed_timestamp", f"{minutes} minutes").alias("w")
        agg = timed.groupBy(w).agg(*_window_aggs()).select("w.start", "w.end", "requests", "errors", "total_bytes")
        if threshold is not None:
            agg = agg.where(F.col("errors") / F.col("requests") > F.lit(threshold))

        def sink(batch: DataFrame, batch_id: int) -> None:
            out.note()
            batch.write.mode("overwrite").parquet(f"{output_path.rstrip('/')}/batch_id={batch_id}")

        out.query = (
            agg.writeStream.outputMode("append").foreachBatch(sink).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start()
        )
    if wait:
        out.query.awaitTermination()
        out.note()
    return out


WINDOW_STATE = "struct<requests:bigint,errors:bigint,total_bytes:bigint>"


def final_windows(spark: SparkSession, output_path: str, tz: str | None = UTC) -> DataFrame:
    """The windows emitted so far, as ``windowed_traffic`` returns them."""
    with time_zone(spark, tz):
        emitted = spark.read.parquet(output_path)
        return _window_select(emitted.withColumn("w", F.struct("start", "end"))).orderBy("window_start")


def open_windows(spark: SparkSession, checkpoint: str, tz: str | None = UTC) -> DataFrame:
    """The windows a stopped stream still holds in its state, with what they
    have counted so far (not final), read from the state store."""
    with time_zone(spark, tz):
        state = spark.read.format("statestore").load(checkpoint)
        held = state.select(F.col("key.*"), F.col("value").cast(WINDOW_STATE).alias("v"))
        return _window_select(held.select(F.col(held.columns[0]).alias("w"), "v.*")).orderBy("window_start")


def late_rows(runs: list[FinalWindows], final: DataFrame, still_open: DataFrame) -> DataFrame:
    """One row ``late_rows``: what the runs of a stream read less what its
    windows count.  (The watermark's own metric counts groups of a partial
    aggregate, not rows.)"""
    counted = final.select("requests").unionAll(still_open.select("requests"))
    seen = sum(r.timed_rows() for r in runs)
    return counted.agg((F.lit(seen).cast("bigint") - F.coalesce(F.sum("requests"), F.lit(0))).alias("late_rows"))
