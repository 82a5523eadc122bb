from pathlib import Path

import pytest

from starwright.session import SETTINGS, prepare
from starwright.storage import intermediates, scratch_dir, shared_root, written


def test_written_frames_go_below_the_shared_folder(spark):
    root = shared_root(spark)
    df = written(spark.range(3), "label")
    assert all(f"{root}/starwright/label-" in name for name in df.inputFiles())
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")


def test_intermediates_are_removed(spark):
    kept = written(spark.range(3), "kept")
    with pytest.raises(RuntimeError), intermediates(spark):
        gone = written(spark.range(3), "gone")
        assert gone.count() == 3
        raise RuntimeError
    (path,) = {name.rsplit("/", 1)[0].removeprefix("file://") for name in gone.inputFiles()}
    assert not Path(path).exists()
    assert kept.count() == 3


class _Session:
    def __init__(self, **options):
        self.options = options

    @property
    def conf(self):
        return self

    def get(self, key, default=None):
        return self.options.get(key.replace(".", "_"), default)


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(_Session(spark_master="yarn"))
    assert shared_root(_Session(spark_master="yarn", spark_checkpoint_dir="hdfs://x/y/")) == "hdfs://x/y"


def test_prepare_sizes_the_shuffle(spark, conf):
    conf(adaptive__coalescePartitions__initialPartitionNum="8")
    prepare(spark, input_bytes=10**12)
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert int(spark.conf.get(key)) == 466
    prepare(spark, input_bytes=100 * 10**12)
    assert int(spark.conf.get(key)) == 20_000
    assert all(spark.conf.get(name) == value for name, value in SETTINGS.items())


def test_local_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(_Session(spark_master="local-cluster[2,1,1024]"))
