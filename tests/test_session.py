from types import SimpleNamespace

import pytest

from tillroll.session import MB, build_session, checkpoint_root, scale_conf


def test_scale_conf_sizes_partitions():
    conf = scale_conf(30 * 10**12, 8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == -(-30 * 10**12 // (256 * MB))
    small = scale_conf(10 * MB, 16)
    assert small["spark.sql.shuffle.partitions"] == "32"          # at least two waves
    assert small["spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes"] == str(1024 * MB)


def test_sized_session(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        sized = build_session(shuffle_bytes=10**12, total_cores=64)
        assert sized.conf.get("spark.sql.shuffle.partitions") == str(-(-10**12 // (256 * MB)))
    finally:
        for key in scale_conf(1, 1):
            spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_checkpoint_root_reads_session_setting(spark):
    assert checkpoint_root(spark) == spark.conf.get("spark.checkpoint.dir")
    unset = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default))
    with pytest.raises(RuntimeError, match="shared folder"):
        checkpoint_root(unset)
