"""Sizing helpers."""

from tessera.session import input_bytes, recommended_conf


def test_recommended_conf_scales_with_input():
    small = recommended_conf(10 * 2**20, cores=8)
    big = recommended_conf(100 * 2**40, cores=8000)
    assert small["spark.sql.shuffle.partitions"] == "8"
    assert int(big["spark.sql.shuffle.partitions"]) == 100 * 2**40 // (256 * 2**20)
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_input_bytes(spark):
    n = input_bytes(spark, "/root/testdata/sf0.001/orders.parquet",
                    "/root/testdata/sf0.001/lineitem.parquet", "/nowhere/x")
    assert n > 0
