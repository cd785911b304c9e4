"""Sources and sinks (S1-S5, K1-K4) on Spark's DataFrameReader/Writer.

Thin by design: the work (pushdown, pruning, parallel scan, partitioned
write) is Spark's.  What these add is the layout decisions -- Silver is
clustered by its partition column before a ``partitionBy`` write so each date
is written by a few tasks instead of every task -- and the type fix on
read-back (a STRING partition column is inferred as DATE).
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

SILVER_PARTITION = "date"
#: Tasks, and so files, per date of a clustered write at most.
DATE_SPLITS = 4


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop FileSystem of the path (works for
    local, HDFS and object-store paths alike)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(str(path))
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath)


def finished(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` holds a finished write (its success marker)."""
    return path_exists(spark, f"{str(path).rstrip('/')}/_SUCCESS")


def delete_path(spark: SparkSession, path: str) -> None:
    """Recursively delete a scratch location through its Hadoop FileSystem
    (local, HDFS or object store)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(str(path))
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


def touch(spark: SparkSession, path: str) -> None:
    """An empty file, as a marker."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(str(path))
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(hpath, True).close()


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Deal unsplittable input (a few large .gz files) to ``partitions`` tasks
    before the CPU-heavy parse.  Off unless the caller asks for it: splittable
    input is parsed where it is read, without a shuffle."""
    return df.repartition(partitions) if partitions else df


def children(spark: SparkSession, path: str, prefix: str = "") -> list[str]:
    """Paths of the folder's entries whose names start with ``prefix``."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(str(path))
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [s.getPath() for s in fs.listStatus(hpath)]
    return sorted(p.toString() for p in found if p.getName().startswith(prefix))


def replace_path(spark: SparkSession, source: str, target: str) -> None:
    """Put ``source`` in the place of ``target``."""
    jvm = spark.sparkContext._jvm
    src, dst = jvm.org.apache.hadoop.fs.Path(str(source)), jvm.org.apache.hadoop.fs.Path(str(target))
    fs = src.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(dst, True)
    if not fs.rename(src, dst):
        raise OSError(f"could not move {source} to {target}")


# ----------------------------------------------------------------- readers
def read(spark: SparkSession, path: str, file_format: str, options: Mapping[str, str] | None = None,
         schema=None) -> DataFrame:
    """S3: any built-in file format (csv, json, orc, parquet, text, ...)."""
    reader = spark.read.format(file_format).options(**dict(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(str(path))


def read_text(spark: SparkSession, path: str, streaming: bool = False, max_files_per_trigger: int | None = None) -> DataFrame:
    """Raw lines as ``value STRING``; a file, a directory, a glob or .gz.

    The streaming form takes a directory and picks up new files as they land.
    """
    if streaming:
        reader = spark.readStream.format("text")
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
        return reader.load(str(path))
    return spark.read.text(str(path))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """S4."""
    return spark.read.parquet(str(path))


def read_silver(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Silver read-back with ``date`` kept as STRING (partition discovery would
    infer DATE and put NULL dates under the Hive default partition).  With a
    ``schema`` a table without rows, and so without files, can be read too."""
    reader = spark.read.option("basePath", str(path))
    df = (reader.schema(schema) if schema is not None else reader).parquet(str(path))
    if SILVER_PARTITION in df.columns:
        df = df.withColumn(SILVER_PARTITION, F.col(SILVER_PARTITION).cast("string"))
    return df


def read_jdbc(spark: SparkSession, url: str, table: str | None = None, query: str | None = None,
              properties: Mapping[str, str] | None = None, partition_column: str | None = None,
              lower_bound: int | None = None, upper_bound: int | None = None,
              num_partitions: int | None = None) -> DataFrame:
    """A table name goes to ``dbtable``; a SELECT goes to ``query``.

    For large tables pass ``partition_column`` with bounds so Spark issues
    ``num_partitions`` range queries in parallel instead of one.
    """
    if (table is None) == (query is None):
        raise ValueError("pass exactly one of table= or query=")
    reader = spark.read.format("jdbc").option("url", url).options(**dict(properties or {}))
    reader = reader.option("dbtable", table) if table is not None else reader.option("query", query)
    if partition_column is not None:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("partition_column needs lower_bound, upper_bound and num_partitions")
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
                  .option("numPartitions", str(num_partitions)))
    return reader.load()


# ----------------------------------------------------------------- writers
def write(df: DataFrame, path: str, file_format: str, mode: str = "overwrite",
          partition_by: Sequence[str] | None = None, options: Mapping[str, str] | None = None) -> None:
    """K1: generic file sink."""
    writer = df.write.format(file_format).mode(mode).options(**dict(options or {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(str(path))


def cluster(df: DataFrame, columns: Sequence[str], splits: int = DATE_SPLITS) -> DataFrame:
    """Bring the rows of one partition value together in at most ``splits``
    tasks: a hot value (a date with a third of all rows) is dealt over that
    many by a salt, whether AQE is on or not."""
    salt = F.pmod(F.xxhash64(*df.columns), F.lit(splits))
    return df.repartition(*columns, salt)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] | None = None,
                  dynamic_overwrite: bool = False, rebalance: bool = True, splits: int = DATE_SPLITS) -> None:
    """K2: Parquet sink (snappy, Spark's default codec); modes overwrite/append.

    ``dynamic_overwrite`` (with ``partition_by`` and mode overwrite) replaces
    only the partitions present in ``df`` -- a daily load rewrites its own
    dates and leaves the rest of the table alone.  With ``partition_by`` the
    rows are clustered by partition value first, at most ``splits`` files per
    value instead of one per task; ``rebalance=False`` skips that shuffle when
    the input is already clustered (time-ordered log files, each task touching
    a few dates).
    """
    options = {"partitionOverwriteMode": "dynamic"} if dynamic_overwrite else None
    if partition_by and rebalance:
        df = cluster(df, partition_by, splits)
    write(df, path, "parquet", mode=mode, partition_by=partition_by, options=options)


def write_silver(df: DataFrame, path: str, mode: str = "overwrite", dynamic_overwrite: bool = False,
                 rebalance: bool = True, splits: int = DATE_SPLITS) -> None:
    """K3: Silver partitioned by ``date`` (optionally replacing only the dates
    present in ``df``; ``rebalance`` and ``splits`` as in ``write_parquet``)."""
    write_parquet(df, path, mode=mode, partition_by=[SILVER_PARTITION], dynamic_overwrite=dynamic_overwrite,
                  rebalance=rebalance, splits=splits)


def write_jdbc(df: DataFrame, url: str | None, table: str, mode: str = "overwrite",
               properties: Mapping[str, str] | None = None, num_partitions: int | None = None,
               batch_size: int | None = None) -> None:
    """K4: JDBC sink.  A missing url is an error; a missing user/driver only warns."""
    if not url:
        raise ValueError("a JDBC url is required")
    props = dict(properties or {})
    for key in ("user", "driver"):
        if not props.get(key):
            log.warning("JDBC property %r is not set", key)
    if num_partitions is not None:
        props["numPartitions"] = str(num_partitions)
    if batch_size is not None:
        props["batchsize"] = str(batch_size)
    df.write.jdbc(url=url, table=table, mode=mode, properties=props)
