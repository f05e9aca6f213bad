"""Spark event logs as a table: single files and rolling folders, plain or
zstd-compressed (what Spark writes by default).

Plain files are read as text, so that large ones are split.  A compressed file
is one task: its frames are decoded as a stream, a piece at a time.  All lines
then take the same JSON reading.
"""

from __future__ import annotations

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, MapType, StringType, StructField, StructType

from tessera import fsutil
from tessera.session import scratch_path

PIECE = 1 << 16          # compressed bytes decoded together


def _longs(*names: str) -> StructType:
    return StructType([StructField(n, LongType()) for n in names])


# The part of the event-log JSON that is read.
EVENT_LOG_SCHEMA = StructType([
    StructField("Event", StringType()),
    StructField("Stage ID", LongType()),
    StructField("Stage Attempt ID", LongType()),
    StructField("Task Metrics", StructType([
        *_longs("Executor Run Time", "Executor CPU Time", "Peak Execution Memory", "Result Size",
                "JVM GC Time", "Memory Bytes Spilled", "Disk Bytes Spilled"),
        StructField("Shuffle Read Metrics", _longs(
            "Remote Bytes Read", "Local Bytes Read", "Total Records Read")),
        StructField("Shuffle Write Metrics", _longs(
            "Shuffle Bytes Written", "Shuffle Records Written")),
        StructField("Input Metrics", _longs("Bytes Read", "Records Read")),
        StructField("Output Metrics", _longs("Bytes Written", "Records Written")),
    ])),
    StructField("Job ID", LongType()),
    StructField("Stage IDs", ArrayType(LongType())),
    StructField("Properties", MapType(StringType(), StringType())),
])
EVENTS = ("SparkListenerTaskEnd", "SparkListenerJobStart")

_ENDINGS = r"([.](zstd|lz4|lzf|snappy))?([.]inprogress)?([.]compact)?$"


def _named(files: DataFrame, path: str, application: str | None) -> DataFrame:
    """``files`` with what the names say: ``base``, ``folder``, ``log``,
    ``part``, ``codec``."""
    p = F.col(path)
    base = F.element_at(F.split(p, "/"), -1)
    folder = F.element_at(F.split(p, "/"), -2)
    rolling = folder.rlike("^eventlog_v2_") & base.rlike(r"^events_\d+_")
    log = (F.url_decode(F.regexp_extract(p, f"/{application}=([^/]*)/", 1)) if application else
           F.when(rolling, F.regexp_extract(folder, "^eventlog_v2_(.*)$", 1))
           .otherwise(F.regexp_replace(base, _ENDINGS, "")))
    part = F.when(rolling, F.regexp_extract(base, r"^events_(\d+)_", 1).cast("long")).otherwise(0)
    return files.withColumns({"base": base, "folder": folder, "log": log, "part": part,
                              "rolling": rolling,
                              "codec": F.regexp_extract(base, _ENDINGS, 2)})


def event_log_files(spark: SparkSession, path: str, application: str | None = None) -> DataFrame:
    """One row per file of the event logs under ``path``: ``file``, ``log``,
    ``part`` (of a rolling log, from 1), ``codec``, ``last`` (the part that is
    written to), ``superseded`` (a compacted file stands for it)."""
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
              .select(F.col("path").alias("file"), "length"))
    named = _named(listed, "file", application).withColumn(
        "dir", F.when(F.col("rolling") | F.col("folder").rlike("^eventlog_v2_"),
                      F.expr("substring(file, 1, length(file) - length(base))"))
        .otherwise(F.col("file")))
    whole = Window.partitionBy("dir")
    compact = F.col("base").endswith(".compact")
    status = F.col("folder").rlike("^eventlog_v2_") & ~F.col("rolling")
    upto = F.max(F.when(compact, F.col("part"))).over(whole)
    return (named.where(~status).withColumn("upto", F.coalesce(upto, F.lit(-1))).withColumns({
        "last": F.col("part") == F.max("part").over(whole),
        "superseded": (F.col("part") < F.col("upto")) | ~compact & (F.col("part") == F.col("upto"))})
        .select("file", "log", "part", "codec", "last", "superseded", "length"))


def _live(spark: SparkSession, file: str) -> bool:
    """Whether the application of a log has not ended, by the file's ending or
    the (empty) status file of a rolling log's folder."""
    return file.endswith(".inprogress") or any(
        "/appstatus_" in f and f.endswith(".inprogress")
        for f in fsutil.list_files(spark, file.rsplit("/", 1)[0]))


def _decoded(files: DataFrame) -> DataFrame:
    """(file, line, torn): the lines of zstd files; a file whose last frame is
    cut off, or that does not decode, ends with a row that says so."""
    def run(batches):
        def lines(content):
            rest, frame, begun = b"", zstandard.ZstdDecompressor().decompressobj(), False
            try:
                for at in range(0, len(content), PIECE):
                    data = content[at:at + PIECE]
                    while data:
                        *whole, rest = (rest + frame.decompress(data)).split(b"\n")
                        yield whole, None
                        data, begun = frame.unused_data, not frame.eof
                        if frame.eof:          # each flush of the writer ends a frame
                            frame = zstandard.ZstdDecompressor().decompressobj()
            except zstandard.ZstdError:
                yield [], "corrupt"
            else:
                yield [rest] if not begun else [], "cut off" if begun else None

        for b in batches:
            for file, content in zip(b.column(0), b.column(1), strict=True):
                for found, torn in lines(content.as_py()):
                    rows = [x.decode("utf-8", "replace") for x in found if x] + [None] * (torn is not None)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([file.as_py()] * len(rows), pa.string()), pa.array(rows, pa.string()),
                         pa.array([torn if r is None else None for r in rows], pa.string())],
                        names=["file", "line", "torn"])

    return files.mapInArrow(run, "file string, line string, torn string")


def read_event_logs(spark: SparkSession, path: str, application: str | None = None) -> DataFrame:
    """Task-end and job-start events of the event logs under ``path``, with
    ``application``: the log's name (file or rolling folder, without endings),
    or the folder column named.

    Logs may be single files or rolling folders, plain or zstd-compressed; a
    compressed file is held by one task as its bytes (Spark rolls at 128 MB;
    at most 2 GB).  The parts read are written once under
    ``spark.checkpoint.dir``, as the columns of ``EVENT_LOG_SCHEMA``.  What a
    live log has not finished writing is left out: an unfinished last line, a
    frame cut off in the last part.  Anything else that does not parse or
    decode raises ``ValueError``, and so do other codecs: nothing is dropped
    silently.
    """
    files = event_log_files(spark, path, application)
    other = files.where("codec not in ('', 'zstd')").limit(5).collect()
    if other:
        raise ValueError(f"event logs of an unknown codec: {[r.file for r in other]}")
    # the listing, the text and the binary reader write a file's path in their own ways
    key = lambda c: F.regexp_replace(F.try_url_decode(c), "^[^/]*:/+", "/")
    files = files.withColumn("key", key("file"))
    reader = spark.read.option("recursiveFileLookup", "true")
    name = F.col("_metadata.file_name")
    packed = name.rlike(r"[.]zstd([.]inprogress)?([.]compact)?$")
    lines = (reader.text(path).where(~packed & ~name.rlike("^appstatus_"))
             .select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"),
                     F.lit(None).cast("string").alias("torn"))
             .unionByName(_decoded(reader.format("binaryFile").load(path).where(packed)
                                   .select("path", "content"))))
    schema = StructType([*EVENT_LOG_SCHEMA, StructField("_broken", StringType())])
    parsed = F.from_json("line", schema, {"columnNameOfCorruptRecord": "_broken"})
    read = (lines.where(F.col("torn").isNotNull() | (F.col("line") != ""))
            .select("file", "torn", F.inline(F.array(parsed)))    # the filter below takes no second parse
            .where(F.col("torn").isNotNull() | F.col("_broken").isNotNull()
                   | F.col("Event").isin(*EVENTS)))
    scratch = scratch_path(spark, "event-logs")
    read.write.parquet(scratch)
    events = spark.read.schema(read.schema).parquet(scratch).withColumn("key", key("file"))
    gone = files.where("superseded").select("key")
    if not gone.isEmpty():           # parts that a compaction has not deleted yet
        events = events.join(gone, "key", "left_anti")
    bad = (events.groupBy("key").agg(F.count("_broken").alias("broken"), F.max("torn").alias("torn"))
           .where("broken > 0 or torn is not null").join(files, "key"))
    for r in bad.toLocalIterator():
        if not r.last or r.broken > 1 or r.torn == "corrupt" or r.torn and not _live(spark, r.file):
            raise ValueError(f"broken lines or frames in the event log {r.file}: "
                             f"{r.torn or r.broken}")
    return (_named(events.where(F.col("Event").isNotNull()), "key", application)
            .withColumn("application", F.col("log"))
            .select("application", *EVENT_LOG_SCHEMA.fieldNames()))
