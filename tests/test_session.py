"""Session helpers: the shared checkpoint folder rule."""

import pytest

from marketframe.session import CLUSTER_CONF, checkpoint_dir, materialize, staging


class _Conf:
    def __init__(self, values):
        self.values = dict(values)

    def get(self, key, default=None):
        return self.values.get(key, default)

    def set(self, key, value):
        self.values[key] = value


class _Session:
    def __init__(self, values):
        self.conf = _Conf(values)

    @property
    def sparkContext(self):  # like Spark Connect: no context
        raise RuntimeError("no SparkContext")


@pytest.mark.parametrize("master", ["yarn", "local-cluster[2,1,1024]", "local[2]", None])
def test_no_folder_is_an_error_on_any_master(master):
    with pytest.raises(RuntimeError, match="share"):  # no context here, as with Spark Connect
        checkpoint_dir(_Session({"spark.master": master} if master else {}))


def test_configured_folder_is_used_as_is():
    assert checkpoint_dir(_Session({"spark.master": "yarn", "spark.checkpoint.dir": "/shared/ckpt"})) == "/shared/ckpt"


def test_staging_removes_what_was_written_inside(spark, tmp_shared):
    import os
    from urllib.parse import urlparse
    with staging(spark):
        df = materialize(spark.range(5), "owned")
        path = urlparse(df.inputFiles()[0]).path
        assert df.count() == 5 and os.path.exists(path)
    assert not os.path.exists(os.path.dirname(path))
    kept = materialize(spark.range(5), "kept")
    assert kept.count() == 5


def test_cluster_profile_leaves_partition_counts_to_aqe():
    assert "spark.sql.shuffle.partitions" not in CLUSTER_CONF
    assert int(CLUSTER_CONF["spark.sql.adaptive.coalescePartitions.initialPartitionNum"]) >= 10000
