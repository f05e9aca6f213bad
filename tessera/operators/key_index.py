"""Finding records by a key index beside a table.

One grouped aggregation gives every data file some blocks; a key belongs to
one block of each file by its hash.  A block keeps the smallest and largest of
its keys and three bitmaps, a partitioned Bloom filter.  A lookup joins the
requested keys to the blocks and opens only the files that may hold one;
files that the index doesn't know are opened too.
"""

from __future__ import annotations

from itertools import islice
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import fsutil
from tessera.operators.erase import (
    MAX_FILE_LITERALS, MAX_KEY_LITERALS, _plan_keys, _request_keys, _request_parts, _Table,
    locate_records,
)
from tessera.operators.file_lists import FileLists, path_key
from tessera.operators.joins import DEFAULT_BROADCAST_ROWS, size_checked
from tessera.session import scratch_path
from tessera.sources.catalog import list_partitions, partition_values

BLOCK_BYTES = 512 * 1024     # of a file for each block; a block's bitmaps take 12 KB
BITS = 32_768                # of a bitmap
MAPS = 3
MAX_LOOKUP_KEYS = 10_000     # more keys are in nearly every file: no index is asked
FOLDERS_AT_ONCE = 1_000

_FILE = ["file", "size", "time"]


def _blocks(size: Column) -> Column:
    """Number of a file's blocks, a power of two: few different numbers."""
    return F.pow(2.0, F.ceil(F.log2(F.greatest(size / BLOCK_BYTES, F.lit(1.0))))).cast("long")


def _bit(key: Column, k: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(k), key), F.lit(BITS))


def _is_set(bitmap: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substr(bitmap, (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10)
    return byte.cast("int").bitwiseAND(F.pow(2.0, bit % 8).cast("int")) > 0


def _index_rows(main: DataFrame, key: str) -> DataFrame:
    k = F.col(key)
    facts = main.select(
        path_key(F.col("_metadata.file_path"), uri=True).alias("file"),
        F.col("_metadata.file_size").alias("size"),
        F.unix_millis("_metadata.file_modification_time").alias("time"), k)
    blocks = _blocks(F.col("size"))
    return (facts.withColumn("blocks", blocks)
            .withColumn("block", F.when(k.isNull(), F.lit(0)).otherwise(
                F.pmod(F.xxhash64(k), F.col("blocks"))))
            .groupBy(*_FILE, "blocks", "block")
            .agg(F.min(k).alias("least"), F.max(k).alias("most"), F.count(k).alias("rows"),
                 *[F.bitmap_construct_agg(F.when(k.isNotNull(), _bit(k, i))).alias(f"map{i}")
                   for i in range(MAPS)]))


def build_key_index(spark: SparkSession, table: str, key: str, index_path: str) -> None:
    """Write the index of ``key`` over all data files of a partitioned table."""
    _index_rows(_Table(spark, table, None).read(), key).write.mode("overwrite").parquet(index_path)


def _listed(lists: FileLists, name: str, folders: dict[str, str]) -> DataFrame:
    lists.list(name, folders)
    return lists.read(name).withColumn("file", path_key(F.col("path")))


def refresh_key_index(spark: SparkSession, table: str, key: str, index_path: str) -> int:
    """Index the files that the index doesn't know, and only those; their
    number.  Files that are gone keep their rows until the next build: a
    lookup starts from the files that are there."""
    target = _Table(spark, table, None)
    lists = FileLists(spark, scratch_path(spark, "index-files"))
    values = (r[0].split("=", 1)[1] for r in list_partitions(spark, table).toLocalIterator())
    found = 0
    while chunk := list(islice(values, FOLDERS_AT_ONCE)):
        folders = target.folders([unquote(v) for v in chunk])
        new = _listed(lists, "files", folders).join(
            spark.read.parquet(index_path).select(*_FILE), _FILE, "left_anti")
        n = lists.write_frame("new", new)
        if n:
            rows = _index_rows(_in_files(target.batch(list(folders)), lists.read("new"), n), key)
            rows.join(size_checked(lists.read("new").select(*_FILE))[0], _FILE, "left_semi").write.mode("append").parquet(index_path)
            found += n
    fsutil.delete(spark, lists.root)
    return found


def _in_files(rows: DataFrame, files: DataFrame, n: int) -> DataFrame:
    """Rows of the listed files (``path``), by their names: a file's name holds
    the id of the job that wrote it."""
    names = [r[0].rsplit("/", 1)[-1] for r in files.select("path").collect()] \
        if n <= MAX_FILE_LITERALS else None
    return rows if names is None else rows.where(F.col("_metadata.file_name").isin(names))


def candidate_files(index: DataFrame, files: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The ``files`` (path, file, size, time) that may hold one of ``keys``,
    and those that the index doesn't know."""
    known = index.join(size_checked(files.select(*_FILE))[0], _FILE, "left_semi")
    levels = [r[0] for r in index.select("blocks").distinct().collect()]     # powers of two
    k = F.col(key)
    sought = keys.select(F.explode(F.array(*[F.lit(n).cast("long") for n in levels] or [F.lit(1)]))
                         .alias("blocks"), k.alias("key")).select(
        "blocks", F.pmod(F.xxhash64("key"), F.col("blocks")).alias("block"), "key")
    may = (F.col("least") <= F.col("key")) & (F.col("key") <= F.col("most"))
    for i in range(MAPS):
        may = may & _is_set(F.col(f"map{i}"), _bit(F.col("key"), i))
    hit = known.join(F.broadcast(sought), ["blocks", "block"]).where(may).select(*_FILE).distinct()
    new = files.join(index.select(*_FILE), _FILE, "left_anti")
    return files.join(hit, _FILE, "left_semi").unionByName(new)


def locate_indexed(spark: SparkSession, table: str, requests: DataFrame, key: str,
                   index_path: str, req_key: str | None = None,
                   req_part: str | None = None) -> DataFrame:
    """``locate_records`` over catalog table ``table``, opening only files
    that the index at ``index_path`` doesn't rule out.

    Files written after the index are searched; so is everything, by
    ``locate_records``, where more than ``MAX_LOOKUP_KEYS`` keys, too many
    partitions or more than ``MAX_FILE_LITERALS`` files come into question.
    """
    target = _Table(spark, table, None)
    part = target.part
    main = target.read()
    keys_df, n, _, few = _plan_keys(_request_keys(requests, req_key or key, key), key,
                                    MAX_KEY_LITERALS, DEFAULT_BROADCAST_ROWS)
    values = partition_values(_request_parts(requests, req_part or part, part), part)
    rest = lambda: locate_records(main, requests, key, part, req_key, req_part)
    if values is None or n > MAX_LOOKUP_KEYS:
        return rest()
    if not n or not values:
        return main.where(F.lit(False))
    lists = FileLists(spark, scratch_path(spark, "index-files"))
    folders = target.folders([str(v) for v in values])
    files = _listed(lists, "files", folders)
    found = lists.write_frame("found", candidate_files(spark.read.parquet(index_path), files, keys_df, key))
    if found > MAX_FILE_LITERALS:
        return rest()
    if not found:
        return main.where(F.lit(False))
    names = [r[0].rsplit("/", 1)[-1] for r in lists.read("found").select("path").collect()]
    rows = target.batch(list(folders)).where(F.col("_metadata.file_name").isin(names))
    if few is not None:
        return rows.where(F.col(key).isin(few))
    return rows.join(F.broadcast(keys_df), key, "left_semi").select(*main.columns)
