"""Cluster sizing."""

from oreflow.session import scale_conf


def test_scale_conf_for_100_tb():
    c = scale_conf(100 << 40, 1000, 8)
    assert int(c["spark.sql.shuffle.partitions"]) > 400_000
    assert c["spark.sql.files.maxPartitionBytes"] == str(256 << 20)
    assert int(c["spark.sql.autoBroadcastJoinThreshold"]) == 64 << 20
