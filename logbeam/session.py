"""Session helpers: time-zone scope, shared scratch locations, test sessions.

Nothing here builds its own SparkSession for library calls: every operator
takes the caller's session.  ``local_session`` exists for tests and bench.
"""

from __future__ import annotations

import contextlib
import functools
import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession

UTC = "UTC"


@contextlib.contextmanager
def time_zone(spark: SparkSession, tz: str | None = UTC) -> Iterator[None]:
    """Build plans in time zone ``tz`` (None: the session's own), then give
    the session its setting back.

    ``date``/``hour``/``minute``/``day_of_week`` follow the session time zone,
    which Spark writes into the expressions when a plan is built, so a
    DataFrame built in the scope keeps its zone outside it.
    """
    key = "spark.sql.session.timeZone"
    before = spark.conf.get(key)
    if tz is None or tz == before:
        yield
        return
    spark.conf.set(key, tz)
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextlib.contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for what is started in the scope, then as before."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def in_utc(build: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A query function whose plan is built in UTC."""

    @functools.wraps(build)
    def wrapper(spark: SparkSession, *args, **kwargs) -> DataFrame:
        with time_zone(spark):
            return build(spark, *args, **kwargs)

    return wrapper


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and scratch output.

    On a cluster this is ``spark.checkpoint.dir`` (a static setting, chosen
    by whoever starts the cluster, visible to every executor); a context
    whose checkpoint folder was already set with ``setCheckpointDir`` uses
    that.  Only when neither exists (a local test session) is a folder
    created and registered with ``setCheckpointDir`` -- the setting itself
    cannot change at run time.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if sc.getCheckpointDir() is None:
        if not root and not re.match(r"local(\[|$)", sc.master):
            # A machine-local folder would not survive a lost executor
            # (local-cluster runs executors of its own, so it counts as a cluster).
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster (HDFS, object store)")
        sc.setCheckpointDir(root or tempfile.mkdtemp(prefix="logbeam-ckpt-"))
    return (root or sc.getCheckpointDir()).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused location under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/logbeam/{name}-{uuid.uuid4().hex[:12]}"


def temporary_path(spark: SparkSession, name: str) -> str:
    """A scratch location, not there yet, in a folder that its file system
    deletes when the driver ends."""
    folder = scratch_path(spark, name)
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop_path)  # only what exists can be marked
    fs.deleteOnExit(hadoop_path)
    return f"{folder}/data"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "logbeam") -> SparkSession:
    """Local session for tests and the benchmark (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", UTC)
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.serializer", os.environ.get("LOGBEAM_SERIALIZER", "org.apache.spark.serializer.KryoSerializer"))
        .config("spark.driver.memory", os.environ.get("LOGBEAM_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
