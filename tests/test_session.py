"""Shared-storage rules: scratch output under spark.checkpoint.dir; no
driver-local fallback on a cluster."""

import pytest

from quarry.session import (clear_session_storage, ensure_checkpoint_dir, scratch_path, session_path,
                            session_table)


def test_scratch_paths_live_under_the_checkpoint_dir(spark):
    root = ensure_checkpoint_dir(spark).rstrip("/")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a.startswith(root + "/") and b.startswith(root + "/") and a != b


def test_session_outputs_are_stable_and_cleared(spark):
    assert session_table(spark, "t") == session_table(spark, "t")
    path = session_path(spark, "x")
    assert path == session_path(spark, "x") != scratch_path(spark, "x")
    spark.range(3).write.mode("overwrite").parquet(path)
    spark.range(3).write.mode("overwrite").saveAsTable(session_table(spark, "t"))
    assert spark.read.parquet(path).count() == 3
    clear_session_storage(spark)
    assert not spark.catalog.tableExists(session_table(spark, "t"))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


class _Conf(dict):
    def get(self, key, default=None):
        return super().get(key, default)

    def set(self, key, value):
        self[key] = value


class _Ctx:
    def __init__(self, master):
        self.master = master
        self.dir = None

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, d):
        self.dir = d


class _Session:
    def __init__(self, master, conf=None):
        self.sparkContext = _Ctx(master)
        self.conf = _Conf(conf or {})


def test_cluster_without_checkpoint_dir_is_an_error():
    with pytest.raises(RuntimeError, match="shared storage"):
        ensure_checkpoint_dir(_Session("yarn"))


def test_configured_checkpoint_dir_is_used_as_is():
    s = _Session("yarn", {"spark.checkpoint.dir": "hdfs://nn/ckpt"})
    assert ensure_checkpoint_dir(s) == "hdfs://nn/ckpt"
    assert s.sparkContext.dir == "hdfs://nn/ckpt"
