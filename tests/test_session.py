"""Checkpoint-folder resolution."""

from types import SimpleNamespace

import pytest

from logbeam.session import checkpoint_root


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


def _spark(master, conf=None, current=None):
    calls = []
    sc = SimpleNamespace(
        master=master,
        getConf=lambda: _Conf(conf or {}),
        getCheckpointDir=lambda: calls[-1] if calls else current,
        setCheckpointDir=calls.append,
    )
    return SimpleNamespace(sparkContext=sc), calls


@pytest.mark.parametrize("master", ["yarn", "spark://h:7077", "local-cluster[2,1,1024]"])
def test_cluster_without_shared_folder_is_an_error(master):
    spark, _ = _spark(master)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(spark)


def test_configured_folder_is_used():
    spark, calls = _spark("yarn", {"spark.checkpoint.dir": "hdfs:///shared/ckpt/"})
    assert checkpoint_root(spark) == "hdfs:///shared/ckpt"
    assert calls == ["hdfs:///shared/ckpt/"]


def test_existing_context_folder_is_kept():
    spark, calls = _spark("yarn", current="hdfs:///already/set")
    assert checkpoint_root(spark) == "hdfs:///already/set" and calls == []


def test_local_session_gets_its_own_folder():
    spark, calls = _spark("local[2]")
    root = checkpoint_root(spark)
    assert calls and root == calls[0].rstrip("/") and "logbeam-ckpt-" in root


def test_temporary_paths_go_when_the_driver_ends(tmp_path):
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parents[1]
    code = (
        "from pyspark.sql import SparkSession; from logbeam.session import temporary_path;"
        "s = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false')"
        f".config('spark.checkpoint.dir', '{tmp_path}').getOrCreate();"
        "p = temporary_path(s, 't'); s.range(3).write.parquet(p); assert s.read.parquet(p).count() == 3; s.stop()"
    )
    subprocess.run([sys.executable, "-c", code], check=True, cwd=root, capture_output=True, timeout=120)
    assert not any(p.suffix == ".parquet" for p in tmp_path.rglob("*"))
