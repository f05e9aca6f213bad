"""File lists as written tables.

A partition may hold millions of files.  Its listing is streamed into Parquet
in chunks, compared by joins, and read back row by row for renames and
deletes; no list of files is held by the driver, put into a plan or a marker.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import fsutil

CHUNK = 20_000        # files written together
SMALL = 2_000         # files that are compared without a join
WORKERS = 8           # concurrent catalog and file-system calls
FILES = "value string, path string, size long, time long"
MOVES = "src string, dst string"


def path_key(path: Column, uri: bool = False) -> Column:
    """A file's path without scheme: the same for the file system's paths and
    (``uri``) those of ``_metadata.file_path``, which are percent-encoded."""
    plain = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))) if uri else path
    return F.regexp_replace(plain, "^[^/]*:/+", "/")


def each(fn: Callable, items: list) -> list:
    """``[fn(x) for x in items]`` with up to ``WORKERS`` catalog or file-system
    calls in flight."""
    if len(items) <= 1:
        return [fn(x) for x in items]
    with ThreadPoolExecutor(max_workers=min(WORKERS, len(items))) as pool:
        return list(pool.map(fn, items))


def stream(fn: Callable, rows: Iterator) -> None:
    """``fn`` of every row, a thousand at a time."""
    while chunk := list(islice(rows, 1000)):
        each(fn, chunk)


class FileLists:
    """Named lists of files under one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def write(self, name: str, rows: Iterable[tuple], schema: str = FILES) -> int:
        """The number of rows written; an earlier list of the name goes."""
        rows, n, path = iter(rows), 0, f"{self.root}/{name}"
        fsutil.delete(self.spark, path)
        while (chunk := list(islice(rows, CHUNK))) or not n:
            frame = self.spark.createDataFrame(chunk, schema)
            frame.coalesce(1).write.mode("append").parquet(path)
            n += len(chunk)
            if not chunk:
                break
        return n

    def write_frame(self, name: str, frame: DataFrame) -> int:
        path = f"{self.root}/{name}"
        frame.write.mode("overwrite").parquet(path)
        return self.read(name).count()

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}")

    def rows(self, name: str) -> Iterator:
        """The rows, a partition at a time."""
        return self.read(name).toLocalIterator(prefetchPartitions=True)

    def list(self, name: str, folders: dict[str, str]) -> int:
        """Writes the files that now stand in ``folders`` (value -> folder)."""
        return self.write(name, ((str(v), *f) for v, folder in folders.items()
                                 for f in fsutil.iter_files(self.spark, folder)))

    def _few(self, name: str) -> set[tuple] | None:
        """A list of at most ``SMALL`` files; None for a longer one."""
        rows = self.read(name).limit(SMALL + 1).collect()
        return {tuple(r) for r in rows} if len(rows) <= SMALL else None

    def missing(self, name: str, folders: dict[str, str]) -> bool:
        """Whether a file of the list is gone or has changed."""
        few = self._few(name)
        if few is not None:
            left = {f[1:] for f in few}
            for folder in set(folders.values()):
                left.difference_update(fsutil.iter_files(self.spark, folder))
            return bool(left)
        self.list("now", folders)
        now = self.read("now")
        return not self.read(name).join(now, ["path", "size", "time"], "left_anti").isEmpty()

    def changed(self, name: str, folders: dict[str, str]) -> set[str]:
        """The values whose folders hold other files than the list says."""
        folders = {str(v): f for v, f in folders.items()}
        if not folders:
            return set()
        few = self._few(name)
        if few is not None:
            return {v for v, folder in folders.items() if {f[1:] for f in few if f[0] == v}
                    != set(fsutil.iter_files(self.spark, folder))}
        self.list("now", folders)
        before = self.read(name).where(F.col("value").isin(list(folders)))
        now, same = self.read("now"), ["value", "path", "size", "time"]
        differ = before.join(now, same, "left_anti").union(now.join(before, same, "left_anti"))
        return {r.value for r in differ.select("value").distinct().collect()}
