"""Catalog tables and their partitions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.functions.naming import quote_ident


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def table_schema(spark: SparkSession, name: str) -> StructType:
    """The catalog schema (data columns, then partition columns)."""
    return spark.table(name).schema


def describe(spark: SparkSession, name: str, partition_spec: str | None = None) -> dict:
    """Catalog facts of a table (or of one partition) from ``DESCRIBE
    FORMATTED``: ``partition_columns``, ``location``, ``type``,
    ``provider``.  The command
    answers from the catalog on the driver; collecting it starts no job."""
    stmt = f"DESCRIBE FORMATTED {quote_ident(name)}"
    if partition_spec:
        stmt += f" {partition_spec}"
    rows = [tuple(r) for r in spark.sql(stmt).collect()]
    info = {"partition_columns": [], "location": None, "type": None, "provider": None}
    section = None
    for col, value, _ in rows:
        col = (col or "").strip()
        if col == "# Partition Information":
            section = "parts"
            continue
        if col.startswith("# "):
            if col != "# col_name":
                section = None
            continue
        if not col:
            section = None
            continue
        if section == "parts":
            info["partition_columns"].append(col)
        elif col == "Location" and info["location"] is None:
            info["location"] = value           # the partition's own comes first
        elif col == "Type":
            info["type"] = (value or "").upper()
        elif col == "Provider":
            info["provider"] = value
    return info


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return describe(spark, name)["partition_columns"]


def list_partitions(spark: SparkSession, name: str) -> DataFrame:
    """``SHOW PARTITIONS``: one ``col=value`` string per partition, column
    ``partition_name``.  Answered from the catalog, no data is read."""
    return (spark.sql(f"SHOW PARTITIONS {quote_ident(name)}")
            .select(F.col("partition").alias("partition_name")))


# Largest partition list turned into literals (static PartitionFilters); a
# longer list is used through a semi join instead (dynamic partition pruning).
MAX_PARTITION_LITERALS = 10000


def partition_values(df: DataFrame, part_col: str,
                     bound: int = MAX_PARTITION_LITERALS) -> list | None:
    """Distinct non-null values of ``part_col``, or ``None`` when there are
    more than ``bound`` of them.  At most ``bound + 1`` values ever reach the
    driver; callers fall back to a semi join when ``None`` comes back.
    """
    rows = (df.select(part_col).where(F.col(part_col).isNotNull()).distinct()
            .limit(bound + 1).collect())
    if len(rows) > bound:
        return None
    return sorted((r[0] for r in rows), key=lambda v: (str(type(v)), v))


def read_partitions(spark: SparkSession, name: str, part_col: str,
                    values: Iterable | DataFrame,
                    bound: int = MAX_PARTITION_LITERALS) -> DataFrame:
    """Rows of table ``name`` in the chosen partitions only.

    ``values`` is a list of partition values or a DataFrame holding
    ``part_col`` (say, a request table).  A DataFrame with at most ``bound``
    distinct values becomes a literal list (static PartitionFilters: only
    those folders are listed and read); beyond that a left semi join, which
    Spark can turn into dynamic partition pruning.
    """
    table = spark.table(name)
    if isinstance(values, DataFrame):
        wanted = values.select(part_col)
        literal = partition_values(wanted, part_col, bound)
        if literal is None:
            return table.join(wanted.where(F.col(part_col).isNotNull()).distinct(),
                              part_col, "left_semi").select(*table.columns)
        values = literal
    return table.where(F.col(part_col).isin(list(values)))
