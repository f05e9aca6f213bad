"""File scans.  Pass an explicit schema at scale: inference is an extra pass
over the input (CSV/JSON) and can pick narrower types than the writer had."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

FORMATS = ("csv", "parquet", "json")


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             header: bool = True, sep: str = ",") -> DataFrame:
    reader = spark.read.option("header", header).option("sep", sep)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def read_parquet(spark: SparkSession, path: str,
                 schema: StructType | str | None = None) -> DataFrame:
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def read_json(spark: SparkSession, path: str,
              schema: StructType | str | None = None) -> DataFrame:
    """JSON lines; without a schema Spark infers one (an extra pass)."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def read_files(spark: SparkSession, fmt: str, path: str,
               schema: StructType | str | None = None, **opts) -> DataFrame:
    fmt = fmt.lower()
    if fmt == "csv":
        return read_csv(spark, path, schema, **opts)
    if fmt == "parquet":
        return read_parquet(spark, path, schema)
    if fmt == "json":
        return read_json(spark, path, schema)
    raise ValueError(f"unsupported file format {fmt!r}; expected one of {FORMATS}")


def read_partition_dirs(spark: SparkSession, path: str, part_col: str, values,
                        schema: StructType | str | None = None, fmt: str = "parquet") -> DataFrame:
    """Only the ``part_col=value`` folders of a partitioned file dataset.

    The filter on the partition column is applied to folder names before any
    file is opened (PartitionFilters); the column itself comes back from the
    folder names, typed by ``schema`` when given (else re-inferred).
    """
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path).where(F.col(part_col).isin(list(values)))


def list_partition_dirs(spark: SparkSession, path: str, part_col: str) -> DataFrame:
    """``SHOW PARTITIONS`` for a partitioned file dataset: one
    ``col=value`` row per folder, from a directory listing (no data read)."""
    from tessera import fsutil
    names = []
    for folder in fsutil.list_dirs(spark, path):
        value = fsutil.partition_dir_value(folder, part_col)
        if value is not None:
            names.append((f"{part_col}={value}",))
    return spark.createDataFrame(sorted(names), "partition_name string")
