"""Checkpoint folder rule: read the cluster's setting; scratch folders only in local mode."""
import pytest

from vigilo.session import ensure_checkpoint_dir


class _Conf(dict):
    def get(self, k, default=None):
        return super().get(k, default)


class _SC:
    def __init__(self, master, conf=None):
        self.master, self._conf, self._dir = master, _Conf(conf or {}), None

    def getCheckpointDir(self):
        return self._dir

    def getConf(self):
        return self._conf

    def setCheckpointDir(self, d):
        self._dir = d


class _Spark:
    def __init__(self, sc):
        self.sparkContext = sc


def test_configured_folder_is_used():
    sc = _SC("yarn", {"spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    assert ensure_checkpoint_dir(_Spark(sc)) == "hdfs:///shared/ckpt"


def test_cluster_without_folder_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_Spark(_SC("spark://master:7077")))


def test_local_mode_gets_a_scratch_folder():
    sc = _SC("local[4]")
    d = ensure_checkpoint_dir(_Spark(sc))
    assert d and "vigilo-ckpt-" in d
