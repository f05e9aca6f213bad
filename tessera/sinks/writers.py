"""File, table and JDBC writes.

Partitioned writes are clustered by the partition columns, else every task
would write a file for every value it holds (tasks x values files).  By default
that is Spark's REBALANCE: AQE merges small values into one task and splits a
hot value over as many tasks as its size asks for, so the number of files
follows the data.  ``files_per_partition=k`` fixes it instead: one shuffle on
``(partition column, hash of the row) mod k``, each value in at most ``k``
files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.sources.files import FORMATS


FILE_BYTES = 256 * 1024 * 1024    # size aimed at where a writer chooses the number of files


def spread_key(df: DataFrame, n: int):
    """0..n-1 per row, a hash of the row and its input partition: identical
    copies from different input splits land on different writers, and a
    retried task (same split, same rows) computes the same value."""
    return F.pmod(F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in df.columns]),
                  F.lit(n))


def cluster_for_write(df: DataFrame, partition_by: str | list[str] | None,
                      files_per_partition: int | None) -> DataFrame:
    """Shuffle on (partition columns, spread) so each partition value is
    written by at most ``files_per_partition`` tasks (and files)."""
    if not partition_by or not files_per_partition:
        return df
    cols = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    return df.repartition(*[F.col(c) for c in cols], spread_key(df, files_per_partition))


def clustered(df: DataFrame, partition_by: str | list[str] | None,
              files_per_partition: int | None) -> DataFrame:
    """``cluster_for_write``, or the rebalance without a given number of files."""
    if not partition_by or files_per_partition:
        return cluster_for_write(df, partition_by, files_per_partition)
    cols = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    return df.hint("rebalance", *[F.col(c) for c in cols])


def _writer(df: DataFrame, fmt: str, mode: str, partition_by, header: bool, options: dict | None):
    fmt = fmt.lower()
    if fmt not in FORMATS:
        raise ValueError(f"unsupported file format {fmt!r}; expected one of {FORMATS}")
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", header)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if partition_by:
        cols = [partition_by] if isinstance(partition_by, str) else list(partition_by)
        w = w.partitionBy(*cols)
    return w


def write_file(df: DataFrame, path: str, fmt: str = "parquet", *, mode: str = "overwrite",
               partition_by: str | list[str] | None = None, header: bool = True,
               files_per_partition: int | None = None, options: dict | None = None,
               dealt: bool = False) -> None:
    """``dealt``: the rows lie by the partition columns already (``clustered``
    on what they are built from, where that is narrower)."""
    if not dealt:
        df = clustered(df, partition_by, files_per_partition)
    _writer(df, fmt, mode, partition_by, header, options).save(path)


def write_table(df: DataFrame, name: str, fmt: str = "parquet", *, mode: str = "overwrite",
                partition_by: str | list[str] | None = None, path: str | None = None,
                files_per_partition: int | None = None, options: dict | None = None) -> None:
    """``saveAsTable``; with ``path`` the table is external at that location."""
    df = clustered(df, partition_by, files_per_partition)
    w = _writer(df, fmt, mode, partition_by, True, options)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)


def cluster_by_key(df: DataFrame, key: str, partition_by: str | None = None,
                   files: int | None = None) -> DataFrame:
    """``df`` dealt by ranges of (partition column, key) with sampled bounds,
    and sorted inside: a key's rows lie together, in one file or at the
    neighbouring ends of two.  A hash of the row comes after the key, so that
    the bounds also cut through a key that holds many rows.  ``files``: the
    number of ranges, else Spark's shuffle partitions (AQE may join small
    ones)."""
    tie = "__tie"
    while tie in df.columns:
        tie = "_" + tie
    order = [F.col(c) for c in ([partition_by] if partition_by else []) + [key]] + [F.col(tie)]
    rows = df.withColumn(tie, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    dealt = rows.repartitionByRange(files, *order) if files else rows.repartitionByRange(*order)
    return dealt.sortWithinPartitions(*order).drop(tie)


def write_clustered(df: DataFrame, key: str, *, path: str | None = None, table: str | None = None,
                    fmt: str = "parquet", mode: str = "overwrite", partition_by: str | None = None,
                    files: int | None = None, options: dict | None = None) -> None:
    """Write to a path or a table, clustered by ``key`` inside each partition:
    readers skip the files and row groups whose key range excludes a key."""
    if (path is None) == (table is None):
        raise ValueError("give exactly one of path= or table=")
    w = _writer(cluster_by_key(df, key, partition_by, files), fmt, mode, partition_by, True, options)
    if table is not None:
        w.saveAsTable(table)
    else:
        w.save(path)


def write(df: DataFrame, *, path: str | None = None, table: str | None = None,
          fmt: str = "parquet", mode: str = "overwrite",
          partition_by: str | list[str] | None = None, date_column: str | None = None,
          files_per_partition: int | None = None) -> None:
    """One write for both storages: a path (file) or a catalog table (db).

    For tables the date column, when named, is stored as a timestamp.
    """
    if (path is None) == (table is None):
        raise ValueError("give exactly one of path= or table=")
    if table is not None:
        if date_column:
            df = df.withColumn(date_column, F.col(date_column).cast("timestamp"))
        write_table(df, table, fmt, mode=mode, partition_by=partition_by,
                    files_per_partition=files_per_partition)
    else:
        write_file(df, path, fmt, mode=mode, partition_by=partition_by,
                   files_per_partition=files_per_partition)


def append_table(df: DataFrame, name: str) -> None:
    """Append rows to an existing table, columns matched by name."""
    cols = df.sparkSession.table(name).columns
    df.select(*cols).write.insertInto(name, overwrite=False)


def insert_overwrite_partitions(df: DataFrame, name: str) -> None:
    """Replace exactly the partitions present in ``df`` (dynamic overwrite);
    every other partition of the table keeps its files untouched.

    ``insertInto`` ignores a writer option here, so the session setting is
    switched for the duration of the write and restored after: run no other
    overwrite in the session meanwhile.  (The erase does not use this.)
    """
    spark = df.sparkSession
    cols = spark.table(name).columns
    key = "spark.sql.sources.partitionOverwriteMode"
    old = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        df.select(*cols).write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(key, old)


def write_jdbc(df: DataFrame, url: str, table: str, *, mode: str = "overwrite",
               column_types: str | None = None, batch_size: int = 10000,
               num_partitions: int | None = None, properties: dict | None = None) -> None:
    """JDBC write; ``num_partitions`` caps concurrent connections to the DB."""
    w = (df.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table)
         .option("batchsize", batch_size))
    if column_types:
        w = w.option("createTableColumnTypes", column_types)
    if num_partitions:
        w = w.option("numPartitions", num_partitions)
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()
