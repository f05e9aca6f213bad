"""Run summaries and per-stage metrics, computed as Spark jobs.

``run_summary`` is the per-label summary report of a load-test run over a
sample table of any size; ``stage_metrics`` reads Spark event logs and
aggregates task-end events per stage.  Both are one ``groupBy``
with partial aggregation, so the shuffle carries one row per task and group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType, IntegerType, LongType, StringType, StructField, StructType, TimestampType,
)

from tessera.sources.event_logs import read_event_logs

# Fields a load-test run saves per sample.
SAMPLE_SCHEMA = StructType([
    StructField("ts", TimestampType()), StructField("elapsed_ms", LongType()),
    StructField("latency_ms", LongType()), StructField("connect_ms", LongType()),
    StructField("idle_ms", LongType()), StructField("label", StringType()),
    StructField("code", StringType()), StructField("message", StringType()),
    StructField("thread_name", StringType()), StructField("success", BooleanType()),
    StructField("bytes", LongType()), StructField("sent_bytes", LongType()),
    StructField("url", StringType()), StructField("threads", IntegerType()),
])


def run_summary(samples: DataFrame, label: str = "label", elapsed: str = "elapsed_ms",
                success: str | None = "success", failed=None, ts: str | None = "ts",
                bytes_col: str | None = None, sent_bytes_col: str | None = None,
                digits: int = 6) -> DataFrame:
    """Per label, and over all under ``TOTAL``: samples, average, min, max, std
    dev, error %, throughput, received/sent bytes (columns of the classic
    summary report).

    ``failed`` may be a Column marking failed samples; otherwise the negation
    of ``success``.  Throughput is samples per second from the start of the
    first to the end of the last sample (``ts`` is a sample's start).
    """
    e = F.col(elapsed)
    if failed is None:
        failed = ~F.col(success) if success else F.lit(False)
    aggs = [
        F.count(F.lit(1)).alias("samples"),
        F.round(F.avg(e), digits).alias("avg_ms"),
        F.min(e).alias("min_ms"),
        F.max(e).alias("max_ms"),
        F.round(F.stddev_pop(e), digits).alias("std_ms"),
        F.round(F.lit(100.0) * F.sum(F.when(failed, 1).otherwise(0)).cast("double")
                / F.count(F.lit(1)), digits).alias("error_pct"),
    ]
    span = None
    if ts:
        # microseconds, for zoned or zone-less timestamps alike (no session
        # time zone involved)
        end = F.col(ts) + F.make_dt_interval(secs=(e / 1000).cast("decimal(18,6)"))
        span = F.timestamp_diff("MICROSECOND", F.min(ts), F.max(end))
        aggs.append(F.round(F.when(span > 0, F.count(F.lit(1)) * F.lit(1e6) / span), digits)
                    .alias("throughput_per_sec"))
    per_sec = (lambda total: F.round(F.when(span > 0, total / F.lit(1024.0) * F.lit(1e6) / span),
                                     digits)) if ts else None
    if bytes_col:
        aggs.append(F.round(F.avg(bytes_col), digits).alias("avg_bytes"))
        if per_sec is not None:
            aggs.append(per_sec(F.sum(bytes_col)).alias("received_kb_per_sec"))
    if sent_bytes_col:
        aggs.append(F.round(F.avg(sent_bytes_col), digits).alias("avg_sent_bytes"))
        if per_sec is not None:
            aggs.append(per_sec(F.sum(sent_bytes_col)).alias("sent_kb_per_sec"))
    total = F.grouping("label") == 1
    out = (samples.withColumn("label", F.col(label)).rollup("label")
           .agg(*aggs, total.alias("is_total")))
    return out.withColumn("label", F.when(F.col("is_total"), F.lit("TOTAL"))
                          .otherwise(F.col("label"))).drop("is_total")


def stage_metrics_frame(events: DataFrame) -> DataFrame:
    """Per application, stage and attempt: tasks, run time (total, slowest task, approximate median
    task -- their ratio shows skew); network: shuffle read bytes, those of other machines
    (``remote_read_bytes``) and write bytes; memory: the largest task's peak; disk: spill (in memory
    and on disk together, and on disk), input and output bytes; ``bytes_per_sec``, the input and
    shuffled bytes that a second of task time takes in."""
    m = F.col("`Task Metrics`")
    sr = m["Shuffle Read Metrics"]
    sw = m["Shuffle Write Metrics"]
    run = m["Executor Run Time"]
    total = lambda c: F.sum(F.coalesce(c, F.lit(0))).cast("bigint")
    return (events.where(F.col("Event") == "SparkListenerTaskEnd")
            .groupBy("application", F.col("`Stage ID`").alias("stage_id"),
                     F.col("`Stage Attempt ID`").alias("attempt"))
            .agg(F.count(F.lit(1)).alias("tasks"),
                 F.sum(run).cast("bigint").alias("run_ms"),
                 F.max(run).cast("bigint").alias("max_task_ms"),
                 F.percentile_approx(run, 0.5).cast("bigint").alias("median_task_ms"),
                 F.sum(F.coalesce(sr["Remote Bytes Read"], F.lit(0))
                       + F.coalesce(sr["Local Bytes Read"], F.lit(0))).cast("bigint")
                 .alias("shuffle_read_bytes"),
                 F.sum(sw["Shuffle Bytes Written"]).cast("bigint").alias("shuffle_write_bytes"),
                 F.sum(F.coalesce(m["Memory Bytes Spilled"], F.lit(0))
                       + F.coalesce(m["Disk Bytes Spilled"], F.lit(0))).cast("bigint")
                 .alias("spill_bytes"),
                 total(sr["Remote Bytes Read"]).alias("remote_read_bytes"),
                 F.max(F.coalesce(m["Peak Execution Memory"], F.lit(0))).alias("peak_memory_bytes"),
                 total(m["Disk Bytes Spilled"]).alias("disk_spill_bytes"),
                 total(m["Input Metrics"]["Bytes Read"]).alias("input_bytes"),
                 total(m["Output Metrics"]["Bytes Written"]).alias("output_bytes"))
            .withColumn("bytes_per_sec", F.when(F.col("run_ms") > 0, (
                F.col("input_bytes") + F.col("shuffle_read_bytes")) * F.lit(1000.0)
                / F.col("run_ms"))))


def stage_metrics(spark: SparkSession, path: str, application: str | None = None) -> DataFrame:
    """Stage metrics of the event log(s) at ``path`` (see ``read_event_logs``)."""
    return stage_metrics_frame(read_event_logs(spark, path, application))


def job_group_metrics(spark: SparkSession, path: str, application: str | None = None) -> DataFrame:
    """Stage metrics rolled up per application and job group
    (``SparkContext.setJobGroup``): job-start events map each stage to its
    group; a join on application and stage carries the totals over.  Both sides
    are per-stage aggregates, so the join is small whatever the size of the log."""
    events = read_event_logs(spark, path, application)
    groups = (events.where(F.col("Event") == "SparkListenerJobStart")
              .select("application", F.col("Properties")["spark.jobGroup.id"].alias("job_group"),
                      F.explode("`Stage IDs`").alias("stage_id"))
              .where(F.col("job_group").isNotNull()).distinct())
    per_stage = stage_metrics_frame(events)
    return (per_stage.join(groups, ["application", "stage_id"])
            .groupBy("application", "job_group")
            .agg(F.countDistinct("stage_id").alias("stages"),
                 F.sum("tasks").alias("tasks"), F.sum("run_ms").alias("run_ms"),
                 F.max("max_task_ms").alias("max_task_ms"),
                 F.sum("shuffle_read_bytes").alias("shuffle_read_bytes"),
                 F.sum("shuffle_write_bytes").alias("shuffle_write_bytes"),
                 F.sum("spill_bytes").alias("spill_bytes"),
                 F.sum("remote_read_bytes").alias("remote_read_bytes"),
                 F.max("peak_memory_bytes").alias("peak_memory_bytes"),
                 F.sum("disk_spill_bytes").alias("disk_spill_bytes"),
                 F.sum("input_bytes").alias("input_bytes"),
                 F.sum("output_bytes").alias("output_bytes"))
            .withColumn("bytes_per_sec", F.when(F.col("run_ms") > 0, (
                F.col("input_bytes") + F.col("shuffle_read_bytes")) * F.lit(1000.0)
                / F.col("run_ms"))))
