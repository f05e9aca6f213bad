"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import io
import os
import zipfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import tessera
from tessera import fsutil

from tessera.operators.joins import HOT_ROWS, size_checked, skew_join
from tessera.session import scratch_path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under ``spark.checkpoint.dir`` and read it back: cuts the
    lineage, survives lost executors, and several passes share one result."""
    path = scratch_path(df.sparkSession, name)
    if _MADE:
        _MADE[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_MADE: list[list[str]] = []


def settled(spark: SparkSession, build: Callable[[], DataFrame], name: str) -> DataFrame:
    """``build()`` written and read back; the scratch tables that it
    materialized on the way are deleted."""
    _MADE.append([])
    try:
        df = build()
        path = scratch_path(spark, name)
        df.write.parquet(path)
    finally:
        for made in _MADE.pop():
            fsutil.delete(spark, made)
    if _MADE:
        _MADE[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this library's modules to the executors (once per application):
    functions that run in Python workers are imported there by name."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    top = os.path.dirname(tessera.__file__)
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    path = scratch_path(spark, "modules") + "/tessera_modules.zip"
    fsutil.write_bytes(spark, path, data.getvalue())
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def text_or_empty(text: str | Column) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def row_key(id_col: str | Column, text_col: str | Column) -> list[Column]:
    """Two 64-bit hashes of (id, text), ``k1`` and ``k2``: identify a row even
    where ids are null or repeat.  Rows equal in both are one document."""
    i = F.col(id_col) if isinstance(id_col, str) else id_col
    t = F.col(text_col) if isinstance(text_col, str) else text_col
    return [F.xxhash64(i, t).alias("k1"), F.xxhash64(F.lit(1), t, i).alias("k2")]


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 24 * 2 ** 20


def broadcast_if_bounded(df: DataFrame) -> DataFrame | None:
    """``broadcast(df)`` if ``df`` (a written table) is measured to hold at
    most ``BROADCAST_ROWS`` rows and ``BROADCAST_BYTES`` bytes, else None."""
    out, _, small = size_checked(df, BROADCAST_ROWS, BROADCAST_BYTES)
    return out if small else None


def attach(rows: DataFrame, table: DataFrame, on: str | list[str], counts: DataFrame,
           how: str = "left") -> DataFrame:
    """``rows.join(table, on, how)`` for a written ``table`` with one row per
    key: broadcast if its measured size is bounded, else a shuffled join in
    which the keys that hold more than ``HOT_ROWS`` of ``rows`` are salted.
    ``counts`` gives ``n``, the number of ``rows`` for each key (at least for
    those that may be hot)."""
    small = broadcast_if_bounded(table)
    if small is not None:
        return rows.join(small, on, how)
    keys = [on] if isinstance(on, str) else on
    hot = counts.where(F.col("n") > HOT_ROWS).select(
        *keys, F.ceil(F.col("n") / HOT_ROWS).cast("int").alias("__salts"))
    return skew_join(rows, table, on, how, hot=hot)


def without_rows(docs: DataFrame, keys: list[Column], gone: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose key is not in ``gone`` (a written table of
    ``k1``, ``k2``); no key of ``docs`` is null."""
    a, b = fresh_name(docs, "k1"), fresh_name(docs, "k2")
    small = broadcast_if_bounded(gone)
    right = (gone if small is None else small).select(
        F.col("k1").alias("g1"), F.col("k2").alias("g2")).alias("g")
    left = docs.withColumns({a: keys[0], b: keys[1]}).alias("d")
    on = (F.col(f"d.{a}") == F.col("g.g1")) & (F.col(f"d.{b}") == F.col("g.g2"))
    return left.join(right, on, "left_anti").select(*[F.col(f"d.`{c}`") for c in docs.columns])
