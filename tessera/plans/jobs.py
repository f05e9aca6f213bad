"""The original jobs as functions: generate, split, read -- each composed of
the operators and one write, parameterised by a dataclass that loads from the
same ``key=value`` text the original jobs used."""

from __future__ import annotations

import dataclasses as dc
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tessera.config import GeneratorConfig, from_properties
from tessera.operators.generate import generate_records, records_for_ids
from tessera.operators.split import split_by_hash, take_from_partition
from tessera.plans.workloads import WorkloadReport, read_workload
from tessera.sinks.writers import write
from tessera.sources.files import read_files


@dc.dataclass(frozen=True)
class StorageConfig:
    """Where a job writes: a path (``storage=file``) or a table (``db``)."""

    storage: str = "file"
    format: str = "parquet"
    path: str | None = None
    table: str | None = None
    partitioned: bool = False
    partition_by: str = "PARTITIONER"
    files_per_partition: int | None = None

    @classmethod
    def from_properties(cls, props: dict[str, str], path_key: str = "file.name",
                        db_key: str = "db.name", table_key: str = "table.name") -> "StorageConfig":
        # The property keys of the original job configs.
        cfg = from_properties(cls, props, {
            "storage": "storage", "format": "format", "path": path_key,
            "partitioned": "partitioned", "partition_by": "partition.field.name"})
        if db_key in props and table_key in props:
            cfg = dc.replace(cfg, table=f"{props[db_key]}.{props[table_key]}")
        return cfg


def store(df: DataFrame, target: StorageConfig, date_column: str | None = None) -> int:
    """Write ``df`` to the target; the row count rides on the write."""
    if target.storage not in ("file", "db"):
        raise ValueError(f"unknown storage {target.storage!r}; expected file or db")
    obs = Observation()
    counted = df.observe(obs, F.count(F.lit(1)).alias("n"))
    part = target.partition_by if target.partitioned else None
    if target.storage == "db":
        if not target.table:
            raise ValueError("storage=db needs a table name")
        write(counted, table=target.table, fmt=target.format, partition_by=part,
              date_column=date_column, files_per_partition=target.files_per_partition)
    elif target.storage == "file":
        if not target.path:
            raise ValueError("storage=file needs a path")
        write(counted, path=target.path, fmt=target.format, partition_by=part,
              files_per_partition=target.files_per_partition)
    else:
        raise ValueError(f"unknown storage {target.storage!r}; expected file or db")
    return int(obs.get["n"])


def generate_job(spark: SparkSession, cfg: GeneratorConfig, target: StorageConfig,
                 ids: DataFrame | None = None, id_col: str = "id",
                 spread: int | None = None) -> int:
    """Generate ``cfg.record_count()`` records (or one per row of ``ids``, see
    ``records_for_ids``) and store them; DATE becomes a timestamp in a table."""
    df = (generate_records(spark, cfg) if ids is None
          else records_for_ids(ids, id_col, cfg, spread=spread))
    return store(df, target, date_column="DATE")


@dc.dataclass(frozen=True)
class SplitConfig:
    ratio: float = 0.1
    seed: int = 42
    record_number: int = 0            # > 0: fixed-count mode
    partition_value: str | None = None
    partition_col: str = "PARTITIONER"

    @classmethod
    def from_properties(cls, props: dict[str, str]) -> "SplitConfig":
        # The property keys of the original splitter config.
        return from_properties(cls, props, {
            "ratio": "split.ratio", "record_number": "split.record.number",
            "partition_value": "split.partitioner.number",
            "partition_col": "partition.field.name"})


def split_job(df: DataFrame, cfg: SplitConfig, keys: str | Sequence[str],
              target: StorageConfig | None = None) -> tuple[DataFrame | None, DataFrame, int]:
    """Ratio mode: (train, test) by key hash; fixed-count mode: (None, first
    ``record_number`` rows of one partition by key).  The test part is
    stored when a target is given; returns its row count (else -1)."""
    if cfg.record_number > 0:
        if cfg.partition_value is None:
            raise ValueError("fixed-count split needs split.partitioner.number")
        train, test = None, take_from_partition(df, cfg.partition_col, cfg.partition_value,
                                                cfg.record_number, keys)
    else:
        train, test = split_by_hash(df, keys, cfg.ratio, cfg.seed)
    n = store(test, target) if target is not None else -1
    return train, test, n


def read_job(spark: SparkSession, column: str, *, fmt: str | None = None,
             path: str | None = None, table: str | None = None,
             repartition: int | None = None) -> WorkloadReport:
    """Scan a file or a table, add one to ``column``, run and count."""
    if (path is None) == (table is None):
        raise ValueError("give exactly one of path= or table=")
    df = spark.table(table) if table else read_files(spark, fmt or "parquet", path)
    return read_workload(df, column, repartition)
