"""The shared work folder comes from the session; local folders only in local mode."""

import pytest

from strata.session import cluster_conf, scratch_path, work_root


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, checkpoint=None):
        self.master = master
        self.checkpoint = checkpoint

    def getCheckpointDir(self):
        return self.checkpoint

    def setCheckpointDir(self, path):
        self.checkpoint = path


class _Session:
    def __init__(self, master, conf=None, checkpoint=None):
        self.conf = _Conf(conf or {})
        self.sparkContext = _Context(master, checkpoint)


def test_configured_checkpoint_dir_wins():
    s = _Session("yarn", {"spark.checkpoint.dir": "hdfs:///shared/ckpt/"})
    assert work_root(s) == "hdfs:///shared/ckpt"
    assert scratch_path(s, "x").startswith("hdfs:///shared/ckpt/strata/x-")


def test_cluster_without_checkpoint_dir_refuses_local_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_root(_Session("k8s://https://cluster:443"))


def test_local_session_without_setting_gets_a_folder():
    s = _Session("local[4]")
    root = work_root(s)
    assert root.startswith("/") and s.sparkContext.checkpoint == root
    assert work_root(s) == root  # reused, not recreated


def test_cluster_conf_sizes_partitions():
    conf = cluster_conf(100 * 1024**4)  # 100 TiB through the largest exchange
    assert conf["spark.sql.shuffle.partitions"] == "409600"  # 256 MiB each
    assert cluster_conf(10 * 1024**3)["spark.sql.shuffle.partitions"] == "200"  # floor
    assert cluster_conf(1024**4)["spark.sql.shuffle.partitions"] == str(1024**4 // (256 << 20))
