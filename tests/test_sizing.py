"""Cluster sizing rule: bounded reduce partitions, at least 3 tasks per core."""

from stationlake.session import scale_settings


def test_sizing_100tb_on_8000_cores():
    c = scale_settings(100 * 2**40, 8000)
    assert int(c["spark.sql.files.maxPartitionBytes"]) == 512 << 20
    assert int(c["spark.sql.shuffle.partitions"]) == 51200
    assert int(c["spark.sql.adaptive.advisoryPartitionSizeInBytes"]) == 256 << 20


def test_sizing_bounds():
    assert int(scale_settings(10**6, 8)["spark.sql.shuffle.partitions"]) == 24
    assert int(scale_settings(10 * 2**50, 8)["spark.sql.shuffle.partitions"]) == 10 * 2**50 // 4 // (512 << 20)
