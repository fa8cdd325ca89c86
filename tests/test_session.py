"""Scratch folders come from the session's checkpoint setting."""

from __future__ import annotations

import pytest

from flagstar.session import scratch_dir


class _Conf(dict):
    def get(self, key, default=None):  # noqa: D401 - dict-like stub
        return super().get(key, default)


class _SC:
    def __init__(self, master, configured=None):
        self.master = master
        self._conf = _Conf({"spark.checkpoint.dir": configured} if configured else {})
        self.set_to = None

    def getConf(self):  # noqa: N802 - mirrors the Spark API
        return self._conf

    def getCheckpointDir(self):  # noqa: N802
        return self.set_to

    def setCheckpointDir(self, path):  # noqa: N802
        self.set_to = path


class _Spark:
    def __init__(self, master, configured=None):
        self.conf = _Conf()
        self.sparkContext = _SC(master, configured)


def test_configured_shared_folder_is_used():
    path = scratch_dir(_Spark("yarn", "hdfs://nn/shared/ckpt/"), "x")
    assert path.startswith("hdfs://nn/shared/ckpt/flagstar/x-")
    assert scratch_dir(_Spark("yarn", "hdfs://nn/shared/ckpt"), "x") != path  # a new folder per call


def test_local_runs_fall_back_to_a_temp_folder():
    spark = _Spark("local[2]")
    path = scratch_dir(spark, "y")
    assert spark.sparkContext.set_to and path.startswith(spark.sparkContext.set_to)


def test_cluster_runs_without_a_shared_folder_refuse():
    with pytest.raises(RuntimeError):
        scratch_dir(_Spark("spark://master:7077"), "z")


def test_real_session_uses_its_setting(spark):
    assert scratch_dir(spark, "w").startswith(spark.conf.get("spark.checkpoint.dir", "").rstrip("/")
                                              or spark.sparkContext.getCheckpointDir().rstrip("/"))
