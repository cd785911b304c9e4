"""Small Spark helpers the operators share."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_root, temporary_path

PACKAGE = Path(__file__).resolve().parents[1]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def saved(df: DataFrame) -> DataFrame:
    """``df`` computed once and cut from its lineage by a reliable checkpoint
    in the shared folder (``spark.checkpoint.dir``), so a lost executor costs
    a re-read, not a recomputation."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def ship(spark: SparkSession) -> None:
    """Give the executors this package (as ``--py-files`` would), once per
    context, so tasks run wherever the driver imported it from."""
    sc = spark.sparkContext
    if getattr(sc, "_logbeam_shipped", False):
        return
    path = Path(tempfile.mkdtemp(prefix="logbeam-py-")) / "logbeam_package.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(PACKAGE.rglob("*.py")):
            z.write(f, f.relative_to(PACKAGE.parent))
    sc.addPyFile(str(path))
    sc._logbeam_shipped = True


def arrow_map(df: DataFrame, work: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with this package on the executors."""
    ship(df.sparkSession)
    return df.mapInArrow(work, schema)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def scratch_name(wanted: str, taken: Sequence[str]) -> str:
    """A column name no caller column has (names compare without case)."""
    used = {c.lower() for c in taken}
    name = wanted
    while name.lower() in used:
        name += "_"
    return name


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a Parquet table in the shared folder and read back:
    like ``saved``, but later reads take only the columns they use.  The table
    goes when the driver ends."""
    path = temporary_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of ids and small values that are broadcast at most (some 50 MB).
SMALL_ROWS = 500_000


def few(df: DataFrame, limit: int = SMALL_ROWS) -> bool:
    """Whether ``df`` (saved, narrow rows) is small enough to broadcast."""
    return df.count() <= limit


def small(df: DataFrame) -> DataFrame:
    """``df`` marked for broadcast if it has few rows; a larger one is joined
    by shuffle, with the same result."""
    return F.broadcast(df) if few(df) else df


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys, null equal to null; the right side's keys go."""
    renamed = {k: f"__right_{k}" for k in keys}
    on = F.lit(True)
    for k, r in renamed.items():
        on = on & F.col(k).eqNullSafe(F.col(r))
    return left.join(right.withColumnsRenamed(renamed), on, how).drop(*renamed.values())
