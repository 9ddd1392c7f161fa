"""Checkpoint-folder policy: use the cluster's setting, never invent a
machine-local folder on a cluster."""

import pytest

from lendlens.session import checkpoint_dir, ensure_checkpoint_dir


class _Ctx:
    def __init__(self, master, current=None):
        self.master, self._dir = master, current

    def getCheckpointDir(self):
        return self._dir

    def setCheckpointDir(self, path):
        self._dir = path


class _Conf:
    def __init__(self, values):
        self._values = values

    def get(self, key, default=None):
        return self._values.get(key, default)


class _Session:
    def __init__(self, master, current=None, conf=None):
        self.sparkContext = _Ctx(master, current)
        self.conf = _Conf(conf or {})


def test_uses_the_configured_folder():
    s = _Session("yarn", conf={"spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    assert checkpoint_dir(s) == "hdfs:///shared/ckpt"
    assert ensure_checkpoint_dir(_Session("yarn", current="s3a://b/ckpt")) == "s3a://b/ckpt"


def test_cluster_without_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_Session("spark://master:7077"))


def test_local_session_gets_a_scratch_folder():
    s = _Session("local[4]")
    path = ensure_checkpoint_dir(s)
    assert path and s.sparkContext.getCheckpointDir() == path
