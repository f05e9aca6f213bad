"""Splits: disjoint, complete, ratio, stable under repartition; fixed-count take."""

import pytest
from pyspark.sql import functions as F

from tessera.operators.split import (
    label_split, split_by_hash, split_random, take_from_partition,
)


def test_hash_split_disjoint_complete_ratio(spark):
    df = spark.range(200000).withColumnRenamed("id", "k")
    train, test = split_by_hash(df, "k", 0.1, seed=42)
    n_train, n_test = train.count(), test.count()
    assert n_train + n_test == 200000
    assert train.join(test, "k").count() == 0
    # 4 sigma of a binomial(200000, 0.1)
    assert abs(n_test - 20000) < 4 * (200000 * 0.1 * 0.9) ** 0.5


def test_hash_split_stable_under_repartition(spark):
    df = spark.range(20000).withColumnRenamed("id", "k")
    a = label_split(df, "k", 0.3).where("part = 'test'")
    b = label_split(df.repartition(7), "k", 0.3).where("part = 'test'")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_hash_split_multi_key(spark):
    df = spark.range(1000).select((F.col("id") % 10).alias("a"), (F.col("id") / 10).cast("int").alias("b"))
    train, test = split_by_hash(df, ["a", "b"], 0.5)
    assert train.count() + test.count() == 1000


def test_small_ratios_are_kept(spark):
    df = spark.range(10_000_000).withColumnRenamed("id", "k")
    _, test = split_by_hash(df, "k", 0.00004)
    assert abs(test.count() - 400) < 4 * 400 ** 0.5
    with pytest.raises(ValueError):
        split_by_hash(df, "k", 1e-11)


def test_random_split_parts_cover_input(spark):
    df = spark.range(10000)
    train, test = split_random(df, 0.1, seed=3)
    assert train.count() + test.count() == 10000


def test_take_from_partition_is_ordered(spark):
    df = spark.range(100).select(F.col("id").alias("k"), (F.col("id") % 20).cast("string").alias("p"))
    rows = take_from_partition(df, "p", "11", 2, "k").collect()
    assert [r.k for r in rows] == [11, 31]


def test_several_keys_are_kept_apart(spark):
    from tessera.operators.split import hash_bucket
    rows = [("a:b", "c"), ("a", "b:c"), (None, "a"), ("a", None), ("a", ""), ("", "a"), (None, None), ("-", None)]
    df = spark.createDataFrame(rows, "a string, b string")
    got = {r[0] for r in df.select(hash_bucket(1, ["a", "b"])).collect()}
    assert len(got) == len(rows) and None not in got
