"""Workloads: read, ingest, file I/O throughput, SQL text."""

from __future__ import annotations

import dataclasses as dc
import time

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tessera.operators.stages import add_one
from tessera.sinks.writers import write_file
from tessera.sources.jdbc import jdbc_bounds, read_jdbc


@dc.dataclass
class WorkloadReport:
    frame: DataFrame
    rows: int
    seconds: float


def timed_noop(df: DataFrame) -> tuple[int, float]:
    """Run the whole plan into the ``noop`` sink; rows counted by ``observe``."""
    obs = Observation()
    t0 = time.perf_counter()
    df.observe(obs, F.count(F.lit(1)).alias("n")).write.format("noop").mode("overwrite").save()
    return int(obs.get["n"]), time.perf_counter() - t0


def read_workload(df: DataFrame, column: str = "BENEFITS",
                  repartition: int | None = None, execute: bool = True) -> WorkloadReport:
    """scan -> (optional round-robin repartition) -> ``column + 1`` -> count.

    The count rides on the single pass (``observe``), not on a second job.
    """
    if repartition:
        df = df.repartition(repartition)
    out = add_one(df, column)
    if not execute:
        return WorkloadReport(out, -1, 0.0)
    rows, secs = timed_noop(out)
    return WorkloadReport(out, rows, secs)


def ingest(df: DataFrame, column: str, out_path: str, fmt: str = "csv",
           repartition: int | None = None) -> WorkloadReport:
    """source -> (repartition) -> ``column + 1`` -> write, counted on the way."""
    if repartition:
        df = df.repartition(repartition)
    out = add_one(df, column)
    obs = Observation()
    t0 = time.perf_counter()
    write_file(out.observe(obs, F.count(F.lit(1)).alias("n")), out_path, fmt)
    return WorkloadReport(out, int(obs.get["n"]), time.perf_counter() - t0)


def jdbc_ingest(spark: SparkSession, url: str, table: str, column: str, out_path: str,
                fmt: str = "csv", partition_column: str | None = None, lower_bound=None,
                upper_bound=None, num_partitions: int | None = None,
                properties: dict | None = None) -> WorkloadReport:
    """Partitioned JDBC read -> ``column + 1`` -> file write.

    With ``partition_column`` but no bounds, the bounds are asked from the
    database (one MIN/MAX query), so the read still runs as
    ``num_partitions`` parallel range queries instead of one task.
    """
    if partition_column and (lower_bound is None or upper_bound is None):
        lower_bound, upper_bound = jdbc_bounds(spark, url, table, partition_column, properties)
        num_partitions = num_partitions or spark.sparkContext.defaultParallelism
    src = read_jdbc(spark, url, table, partition_column=partition_column,
                    lower_bound=lower_bound, upper_bound=upper_bound,
                    num_partitions=num_partitions, properties=properties)
    return ingest(src, column, out_path, fmt)


@dc.dataclass
class IOReport:
    files: DataFrame          # one row per written file (or bucket)
    write_seconds: float
    read_seconds: float
    total_bytes: int
    total_rows: int

    @property
    def write_mb_per_sec(self) -> float:
        return self.total_bytes / 1e6 / self.write_seconds if self.write_seconds else 0.0

    @property
    def read_mb_per_sec(self) -> float:
        return self.total_bytes / 1e6 / self.read_seconds if self.read_seconds else 0.0


def _read_back(spark: SparkSession, path: str, fmt: str, group: str, write_seconds: float
               ) -> IOReport:
    """Read every column of every row once (into the ``noop`` sink, timed),
    then report rows and bytes per ``group`` from the files' own figures."""
    back = spark.read.format(fmt).load(path)
    rows, read_seconds = timed_noop(back)
    per_file = (back.withColumns({"file_name": F.col("_metadata.file_name"),
                                  "file_size": F.col("_metadata.file_size")})
                .groupBy(*dict.fromkeys([group, "file_name"]))
                .agg(F.count(F.lit(1)).alias("row_count"), F.max("file_size").alias("bytes")))
    if group != "file_name":
        per_file = per_file.groupBy(group).agg(
            F.sum("row_count").alias("row_count"), F.sum("bytes").alias("bytes"),
            F.count(F.lit(1)).alias("files"))
    total = per_file.agg(F.sum("bytes")).first()[0]
    return IOReport(per_file, write_seconds, read_seconds, int(total or 0), rows)


def io_files(df: DataFrame, path: str, n_files: int, bucket: Column | None = None,
             fmt: str = "parquet", writers_per_bucket: int = 1) -> IOReport:
    """Write ``df`` as ``n_files`` files, read all of them back, report rows and
    bytes per file (TestDFSIO-style throughput as a Spark job).

    Without ``bucket`` rows go round-robin (equal-sized files whatever the key
    skew).  With ``bucket`` (an int column expression in 0..n_files-1) the
    rows of a bucket go to folder ``file_no=<b>``, one file each; more
    ``writers_per_bucket`` split a hot bucket over that many tasks and files.
    """
    t0 = time.perf_counter()
    if bucket is None:
        write_file(df.repartition(n_files), path, fmt)
    else:
        write_file(df.withColumn("file_no", bucket.cast("int")), path, fmt,
                   partition_by="file_no", files_per_partition=writers_per_bucket)
    return _read_back(df.sparkSession, path, fmt, "file_name" if bucket is None else "file_no",
                      time.perf_counter() - t0)


def io_generated(spark: SparkSession, path: str, n_files: int, rows_per_file: int,
                 fmt: str = "parquet", cfg=None) -> IOReport:
    """The file I/O test on generated records (n files x rows each): the
    records are generated straight into ``n_files`` tasks, so each task
    writes one file and nothing is shuffled -- only storage throughput is
    measured.  Reads the files back and reports rows and bytes per file."""
    from tessera.config import GeneratorConfig
    from tessera.operators.generate import generate_records
    df = generate_records(spark, cfg or GeneratorConfig(), n=n_files * rows_per_file,
                          num_partitions=n_files)
    t0 = time.perf_counter()
    write_file(df, path, fmt)
    return _read_back(spark, path, fmt, "file_name", time.perf_counter() - t0)


def run_sql(spark: SparkSession, text: str, tables: dict[str, DataFrame] | None = None,
            args: dict | None = None) -> DataFrame:
    """Run SQL text (inline or read from a file) over named DataFrames.

    The DataFrames are temp views of the given names while the text is
    analysed; views of the caller with these names are put back.  One trailing
    ``;`` is taken off, all else is left to Spark's parser; values go in as
    named parameters (``:name``), never pasted into the text.
    """
    text = text.strip().removesuffix(";")
    hidden = {}
    for name, df in (tables or {}).items():
        if spark.catalog.tableExists(name) and spark.catalog.getTable(name).isTemporary:
            hidden[name] = spark.table(name)
        df.createOrReplaceTempView(name)
    try:
        return spark.sql(text, args=args) if args else spark.sql(text)
    finally:
        for name in tables or {}:
            spark.catalog.dropTempView(name)
        for name, df in hidden.items():
            df.createOrReplaceTempView(name)


def run_sql_file(spark: SparkSession, path: str, tables: dict[str, DataFrame] | None = None,
                 args: dict | None = None) -> DataFrame:
    """Run the SQL text stored in a file (any Hadoop path; read by Spark)."""
    row = spark.read.text(path, wholetext=True).first()
    if row is None:
        raise ValueError(f"no SQL text in {path}")
    return run_sql(spark, row[0], tables, args)


def sql_to_file(spark: SparkSession, text: str, path: str, fmt: str = "json",
                tables: dict[str, DataFrame] | None = None, args: dict | None = None) -> DataFrame:
    """Run SQL text and store the answer (the JDBC sampler's saved response)."""
    answer = run_sql(spark, text, tables, args)
    write_file(answer, path, fmt)
    return answer
