"""The helpers that carry the scale decisions."""

import pytest

from stockpilot.session import cluster_conf, shared_dir


def test_cluster_partitions_follow_the_largest_shuffle():
    mb = 1 << 20
    assert cluster_conf(10 * mb)["spark.sql.shuffle.partitions"] == "200"
    assert cluster_conf(1024 * 256 * mb)["spark.sql.shuffle.partitions"] == "1024"
    assert cluster_conf(1 << 60)["spark.sql.shuffle.partitions"] == str(1 << 32)
    assert cluster_conf(10 * mb)["spark.sql.adaptive.enabled"] == "true"


class _Context:
    master = "spark://cluster:7077"

    def getCheckpointDir(self):
        return None


class _Conf:
    def get(self, key, default=None):
        return default


class _Session:
    sparkContext = _Context()
    conf = _Conf()


def test_cluster_session_without_shared_folder_is_refused():
    with pytest.raises(RuntimeError):
        shared_dir(_Session())
