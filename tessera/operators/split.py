"""Reproducible splits and samples.

``split_by_hash`` is the default: membership is a pure function of
``(seed, key)``, so it is the same on any partitioning, on a rerun, after an
executor loss, and in the SQL oracle.  ``split_random`` keeps Spark's
``randomSplit`` contract for rows without a key (stable only on the same plan
and partitioning).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.naming import check_columns

RESOLUTION = 2 ** 32   # the ratio is applied in steps of 1 / 2**32


def hash_bucket(seed: int, keys: Sequence[str]) -> Column:
    """0..RESOLUTION-1 (32 bits) from the md5 of ``"<seed>:<key>"``.  Of several
    keys each is written with its length before it, a null as ``-``: different
    keys never read alike."""
    texts = [F.col(k).cast("string") for k in keys]
    key = texts[0] if len(keys) == 1 else F.concat(*[
        F.coalesce(F.concat(F.length(t), F.lit(":"), t), F.lit("-")) for t in texts])
    h = F.md5(F.concat(F.lit(f"{seed}:"), key))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint")


def label_split(df: DataFrame, keys: str | Sequence[str], ratio: float, seed: int = 42,
                label: str = "part", test: str = "test", train: str = "train") -> DataFrame:
    """Add ``label``: ``test`` for about ``ratio`` of the keys, else ``train``."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    check_columns(df, *keys)
    if not 0.0 <= ratio <= 1.0:
        raise ValueError("ratio must be in [0, 1]")
    cut = int(round(ratio * RESOLUTION))
    if ratio and not cut:
        raise ValueError(f"ratio {ratio} is below 1 / 2**32, the finest that a key's hash can tell")
    return df.withColumn(label, F.when(hash_bucket(seed, keys) < F.lit(cut), F.lit(test))
                         .otherwise(F.lit(train)))


def split_by_hash(df: DataFrame, keys: str | Sequence[str], ratio: float,
                  seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(train, test): disjoint, together the whole input; no shuffle."""
    labelled = label_split(df, keys, ratio, seed, label="__part")
    train = labelled.where(F.col("__part") == "train").drop("__part")
    test = labelled.where(F.col("__part") == "test").drop("__part")
    return train, test


def split_random(df: DataFrame, ratio: float, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(train, test) by Spark's seeded ``randomSplit``."""
    train, test = df.randomSplit([1.0 - ratio, ratio], seed=seed)
    return train, test


def take_from_partition(df: DataFrame, part_col: str, value, n: int,
                        order_by: str | Sequence[str]) -> DataFrame:
    """``n`` rows of one partition, the first ``n`` by ``order_by``.

    Planned as TakeOrderedAndProject: each task keeps its own top ``n``, only
    ``n * tasks`` rows meet in the final merge.
    """
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    check_columns(df, part_col, *order)
    return df.where(F.col(part_col) == F.lit(value)).orderBy(*order).limit(n)


def repartition_rows(df: DataFrame, n: int) -> DataFrame:
    """Round-robin redistribution into ``n`` partitions (a workload knob)."""
    if n <= 0:
        raise ValueError("n must be positive")
    return df.repartition(n)
