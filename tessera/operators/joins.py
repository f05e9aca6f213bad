"""Join helpers: prefixing the right side, and broadcast behind a size check."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tessera.functions.naming import quote_ident

# Largest side we broadcast by our own decision.  Above either bound the join
# is left to Spark: sort-merge on the key, with AQE free to switch to a
# broadcast at run time from *measured* shuffle sizes and to split skewed
# partitions.
DEFAULT_BROADCAST_ROWS = 2_000_000
DEFAULT_BROADCAST_BYTES = 256 * 1024 * 1024


def measure(df: DataFrame) -> tuple[int, int]:
    """(rows, approximate bytes) of ``df`` in one job: the bytes are the
    summed text length of every value plus 8 bytes of overhead per value."""
    if not df.columns:
        return df.count(), 0
    width = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + F.lit(8)
                 for c in df.columns), F.lit(0))
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("b")).first()
    return int(row["n"]), int(row["b"] or 0)


def size_checked(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                 max_bytes: int = DEFAULT_BROADCAST_BYTES) -> tuple[DataFrame, int, bool]:
    """Return ``(df or broadcast(df), row_count, broadcast?)``.

    The size is measured by one job over this (request-sized) side; only a
    side proven to hold at most ``max_rows`` rows and ``max_bytes`` bytes
    gets the broadcast hint.
    """
    n, nbytes = measure(df)
    small = n <= max_rows and nbytes <= max_bytes
    return (F.broadcast(df) if small else df), n, small


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                       max_bytes: int = DEFAULT_BROADCAST_BYTES) -> tuple[DataFrame, int]:
    """``size_checked`` without the flag: ``(df or broadcast(df), row_count)``."""
    out, n, _ = size_checked(df, max_rows, max_bytes)
    return out, n


def prefix_columns(df: DataFrame, prefix: str, keep: tuple[str, ...] = ()) -> DataFrame:
    return df.select(*[F.col(c).alias(c if c in keep else prefix + c) for c in df.columns])


# A key is hot when one side holds more rows for it than one task should
# process; its rows are then spread over ceil(rows / HOT_ROWS) salt buckets.
HOT_ROWS = 1_000_000


HOT_KEYS = 100_000   # most hot keys that travel through the driver

HOT_SAMPLE = 0.01   # fraction of rows sampled to find hot keys


def hot_keys(df: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS,
             sample: float = HOT_SAMPLE, seed: int = 17) -> DataFrame:
    """Keys estimated to hold more than ``hot_rows`` rows, with their salt
    count, as a DataFrame.

    Counted on a seeded ``sample`` of the key columns only, so finding hot
    keys costs a small fraction of the join's own shuffle; a key with a
    million rows shows up ~10 000 times in a 1 % sample.  An estimate off by
    a little only changes the number of salts, never the join result.  At
    most rows/hot_rows keys qualify.
    """
    src = df.select(*keys)
    if sample < 1.0:
        src = src.sample(fraction=sample, seed=seed)
    est = F.count(F.lit(1)) / F.lit(sample)
    return (src.groupBy(*keys).agg(est.alias("__rows"))
            .where(F.col("__rows") > hot_rows)
            .select(*keys, F.ceil(F.col("__rows") / F.lit(hot_rows)).cast("int").alias("__salts")))


TRACKED_KEYS = 65_536   # counters of the one-pass sketch


def copy_with_hot_keys(df: DataFrame, keys: list[str], path: str, hot_rows: int = HOT_ROWS,
                       tracked: int = TRACKED_KEYS) -> tuple[DataFrame, dict[str, DataFrame | None]]:
    """Write ``df`` to ``path`` and find the hot values of each of ``keys`` on
    the way: (the copy, key -> its hot keys as ``hot_keys`` gives them).

    Counted by Spark's mergeable top-k sketch, in the same job.  With
    ``tracked`` counters its counts are off by at most 3.5 n / tracked for n
    rows, and every value with more rows is in it; where that is more than
    half of ``hot_rows`` (n above some ten billion), the entry is None: count
    on the copy instead.
    """
    obs = Observation()
    plain = ("string", "int", "bigint", "smallint", "tinyint", "date", "timestamp", "double", "float")
    others = [k for k in keys if df.schema[k].dataType.simpleString() not in plain]
    keys = [k for k in keys if k not in others]
    found = [F.expr(f"approx_top_k({quote_ident(k)}, {tracked // 4}, {tracked})").alias(f"top{i}")
             for i, k in enumerate(keys)]
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"), *found) if keys else df
    observed.write.parquet(path)
    spark = df.sparkSession
    copy = spark.read.schema(df.schema).parquet(path)
    hot: dict[str, DataFrame | None] = dict.fromkeys(others)
    for i, k in enumerate(keys):
        n, error = obs.get["rows"], 3.5 * obs.get["rows"] / tracked
        schema = StructType([df.schema[k], StructField("__salts", IntegerType())])
        # counts may be short by the error: a key above the bound is never missed
        rows = [(r["item"], max(1, math.ceil((r["count"] + error) / hot_rows)))
                for r in obs.get[f"top{i}"] or []
                if r["item"] is not None and r["count"] + error > hot_rows]
        hot[k] = spark.createDataFrame(rows, schema) if error <= hot_rows / 2 or n <= hot_rows else None
    return copy, hot


def skew_join(big: DataFrame, other: DataFrame, on: str | list[str], how: str = "inner",
              hot_rows: int = HOT_ROWS, hot: DataFrame | None = None,
              sample: float = HOT_SAMPLE) -> DataFrame:
    """Equi-join that splits hot keys of ``big`` over several tasks.

    Rows of ``big`` with a hot key get a salt in 0..s-1 (hash of the row and
    its input split: deterministic on retry, different for copies from
    different splits); rows of ``other`` with that key are replicated once
    per salt.  Every other key has salt 0 and no replication, so the result
    equals ``big.join(other, on, how)`` for inner / left / left_semi /
    left_anti joins.  Hot keys are looked for once; without any this is the
    plain join.  Up to ``HOT_KEYS`` of them are a broadcast side, more stay
    data and Spark sizes the side itself.
    The salt hashes every column of ``big``: project ``big`` to the columns
    you need first, or the scan cannot prune the rest.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if how not in ("inner", "left", "left_outer", "left_semi", "left_anti"):
        raise ValueError(f"skew_join supports inner/left/semi/anti, not {how}")
    if hot is None:
        hot = hot_keys(big, keys, hot_rows, sample)
    # found once: at most rows/hot_rows keys, for all three uses below
    found = hot.limit(HOT_KEYS + 1).collect()
    if len(found) <= HOT_KEYS:
        hot = F.broadcast(big.sparkSession.createDataFrame(found, hot.schema))
    known = [F.col(k).isNotNull() for k in keys]
    keyed = known[0]
    for k in known[1:]:
        keyed = keyed & k
    inner = how in ("inner", "left_semi")
    # a null key matches nothing: such rows pass by the join instead of all
    # meeting in one of its tasks
    loose = None if inner else big.where(~keyed)
    rows = big.where(keyed)
    if not found:
        out = rows.join(other, on, how)
    else:
        cols = [F.col(c) for c in big.columns]
        salted = (rows.join(hot, keys, "left")
                  .withColumn("__salt", F.when(F.col("__salts").isNull(), F.lit(0)).otherwise(
                      F.pmod(F.xxhash64(F.spark_partition_id(), *cols),
                             F.col("__salts")).cast("int")))
                  .drop("__salts"))
        replicated = (other.join(hot, keys, "left")
                      .withColumn("__salt", F.explode(
                          F.when(F.col("__salts").isNull(), F.array(F.lit(0)))
                          .otherwise(F.sequence(F.lit(0), F.col("__salts") - 1))))
                      .drop("__salts"))
        out = salted.join(replicated, keys + ["__salt"], how).drop("__salt")
    if how in ("left_semi", "left_anti"):
        out = out.select(*big.columns)
    return out if loose is None else out.unionByName(loose, allowMissingColumns=True)
