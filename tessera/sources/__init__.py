"""Scans: files (csv, parquet, json), catalog tables and partitions, JDBC."""

from tessera.sources.files import (
    read_csv, read_parquet, read_json, read_files, read_partition_dirs, list_partition_dirs,
)
from tessera.sources.catalog import (
    read_table, read_partitions, list_partitions, partition_values, table_schema,
    partition_columns, describe,
)
from tessera.sources.jdbc import read_jdbc

__all__ = [
    "read_csv", "read_parquet", "read_json", "read_files", "read_partition_dirs", "list_partition_dirs",
    "read_table", "read_partitions", "list_partitions", "partition_values",
    "table_schema", "partition_columns", "describe", "read_jdbc",
]
