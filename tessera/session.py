"""Session helpers: a local session for tests/bench and the shared scratch area.

Scratch output (staging copies, round-trip files, scratch tables) always lives
under the folder named by ``spark.checkpoint.dir``: on a cluster that is a
shared file system every executor can reach.  Only when the setting is unset on
a *local* master (tests, bench) do we create one ourselves.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def default_driver_memory(fraction: float = 0.6, cap_gb: int = 16) -> str:
    """Driver heap for a local session: a share of this machine's RAM (the
    driver is the only JVM in local mode), at most ``cap_gb``."""
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES") / 2**30
    except (ValueError, OSError, AttributeError):
        total = 8.0
    return f"{max(1, min(cap_gb, int(total * fraction)))}g"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tessera", extra: dict | None = None) -> SparkSession:
    """A local session tuned for small test data (UI off, AQE on, UTC)."""
    b = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # fall back from whole-stage codegen when a stage's method would be
        # too large for the JIT (8000 bytecodes on HotSpot); wide projections
        # such as the record generator otherwise run interpreted
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.driver.memory", default_driver_memory())
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate output, from ``spark.checkpoint.dir``.

    Set our own only when it is unset and the master is local.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder "
                "(HDFS/S3/NFS) that every executor can reach")
        root = tempfile.mkdtemp(prefix="tessera-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root.rstrip("/")


def stable_root(spark: SparkSession) -> str:
    """The configured checkpoint folder itself, without the per-application
    subfolder Spark adds: state that must outlive a crashed driver (the
    erase markers) lives here, so a restarted application finds it."""
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        return conf.rstrip("/")
    return scratch_root(spark).rsplit("/", 1)[0]


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path under the scratch root; callers never share one."""
    return "/".join([scratch_root(spark), *parts, uuid.uuid4().hex[:12]])


def unique_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:12]}"


def as_uri(path: str) -> str:
    """Keep a path that has a scheme (``hdfs:``, ``s3a:``, ``file:``); make a
    bare local path absolute with ``file://``."""
    if re.match(r"^[A-Za-z][A-Za-z0-9+.-]*:", path):
        return path
    return "file://" + os.path.abspath(path)


def scratch_database(spark: SparkSession) -> str:
    """A catalog database whose managed tables live under the scratch root."""
    root = scratch_root(spark)
    name = "tessera_scratch_" + uuid.uuid5(uuid.NAMESPACE_URL, root).hex[:10]
    if not spark.catalog.databaseExists(name):
        location = as_uri(root + "/warehouse/" + name)
        from tessera.functions.naming import sql_literal
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION {sql_literal(location)}")
    return name


def input_bytes(spark: SparkSession, *paths: str) -> int:
    """Total size of the given inputs, from the file system's content summary
    (metadata only)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(conf)
        if fs.exists(p):
            total += int(fs.getContentSummary(p).getLength())
    return total


def recommended_conf(total_input_bytes: int, cores: int,
                     partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Session settings sized for an input of ``total_input_bytes`` on
    ``cores`` executor cores: scan splits and shuffle partitions of about
    ``partition_bytes`` (so a task's share fits in executor memory without
    spilling), never fewer tasks than cores, AQE coalescing and skew splitting
    on, and a broadcast limit that stays far below a task's memory."""
    parts = max(cores, -(-total_input_bytes // partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        "spark.sql.codegen.hugeMethodLimit": "8000",
    }
