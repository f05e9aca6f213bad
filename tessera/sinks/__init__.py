"""Writes: files, catalog tables, partitioned variants, append, JDBC."""

from tessera.sinks.writers import (
    write, write_file, write_table, append_table, insert_overwrite_partitions,
    write_jdbc, cluster_for_write, clustered, cluster_by_key, write_clustered,
)

__all__ = [
    "write", "write_file", "write_table", "append_table",
    "insert_overwrite_partitions", "write_jdbc", "cluster_for_write", "clustered",
    "cluster_by_key", "write_clustered",
]
