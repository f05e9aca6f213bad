"""Thin access to the Hadoop FileSystem of a path (HDFS, S3A, local...).

Used only for bookkeeping of scratch folders (exists / delete / list); data
always moves through Spark reads and writes.
"""

from __future__ import annotations

from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, True)) if fs.exists(p) else False


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().toString() for s in fs.listStatus(p) if s.isDirectory()]


def partition_dir_value(dirname: str, column: str) -> str | None:
    """``col=value`` folder name -> value text (Spark escapes with %XX)."""
    base = dirname.rstrip("/").rsplit("/", 1)[-1]
    prefix = column + "="
    return unquote(base[len(prefix):]) if base.startswith(prefix) else None


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file (a marker) atomically enough for a marker:
    written under a temporary name, then renamed into place."""
    fs, p = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    tmp = jvm.org.apache.hadoop.fs.Path(path + ".tmp")
    out = fs.create(tmp, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    if fs.exists(p):
        fs.delete(p, False)
    if not fs.rename(tmp, p):
        raise OSError(f"could not move marker into place at {path}")


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """Write a small file."""
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()


def create_new(spark: SparkSession, path: str, data: bytes) -> bool:
    """Write a small file that must not exist yet; False if it does.  Of
    several callers one succeeds."""
    fs, p = _fs(spark, path)
    if not fs.exists(p.getParent()):
        fs.mkdirs(p.getParent())
    try:
        if fs.getUri().getScheme() == "file":     # there ``create`` looks first, then writes
            if not spark.sparkContext._jvm.java.io.File(p.toUri().getPath()).createNewFile():
                return False
            out = fs.create(p, True)
        else:
            out = fs.create(p, False)
    except Py4JJavaError as e:
        if "AlreadyExists" in str(e.java_exception):
            return False
        raise
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _uri_path(spark: SparkSession, uri: str):
    """A Hadoop Path from a URI string as Spark reports it (``_metadata.file_path``
    escapes characters such as spaces, so it is parsed as a URI)."""
    jvm = spark.sparkContext._jvm
    return jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri))


def uri_path(spark: SparkSession, uri: str) -> str:
    """The file's path as ``list_files`` and ``list_facts`` give it."""
    return _uri_path(spark, uri).toString()


def file_facts(spark: SparkSession, path: str) -> list | None:
    """[size, modification time] of a file, None without it."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    s = fs.getFileStatus(p)
    return [int(s.getLen()), int(s.getModificationTime())]


def list_facts(spark: SparkSession, path: str) -> list[list]:
    """[path, size, modification time] of the data files directly under
    ``path``, sorted."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted([s.getPath().toString(), int(s.getLen()), int(s.getModificationTime())]
                  for s in fs.listStatus(p)
                  if s.isFile() and not s.getPath().getName().startswith(("_", ".")))


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Data files directly under ``path`` (names starting with ``_`` or ``.``
    -- markers, checksums -- are skipped)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    out = []
    for s in fs.listStatus(p):
        name = s.getPath().getName()
        if s.isFile() and not name.startswith(("_", ".")):
            out.append(s.getPath().toString())
    return out


def iter_files(spark: SparkSession, path: str):
    """(path, size, modification time) of the data files directly under
    ``path``, one after the other: the list as a whole is held nowhere."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return
    found = fs.listStatusIterator(p)
    while found.hasNext():
        s = found.next()
        name = s.getPath().getName()
        if s.isFile() and not name.startswith(("_", ".")):
            yield s.getPath().toString(), int(s.getLen()), int(s.getModificationTime())


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether a data file stands directly under ``path``."""
    return next(iter_files(spark, path), None) is not None


def rename(spark: SparkSession, src: str, dst: str) -> bool:
    fs, s = _fs(spark, src)
    _, d = _fs(spark, dst)
    return bool(fs.rename(s, d))
