"""JDBC scan with partitioned reads.

Without ``partition_column`` a JDBC read is one task over the whole table; at
scale always pass a numeric/date column with bounds so ``num_partitions`` tasks
each read one stride.  Credentials come from the caller (e.g. environment),
never from logs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(spark: SparkSession, url: str, table: str, *,
              partition_column: str | None = None, lower_bound=None, upper_bound=None,
              num_partitions: int | None = None, custom_schema: str | None = None,
              fetch_size: int | None = 10000, properties: dict | None = None) -> DataFrame:
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partition_column needs lower_bound, upper_bound, num_partitions")
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(lower_bound))
                  .option("upperBound", str(upper_bound))
                  .option("numPartitions", int(num_partitions)))
    if custom_schema:
        reader = reader.option("customSchema", custom_schema)
    if fetch_size:
        reader = reader.option("fetchsize", int(fetch_size))
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    return reader.load()


def jdbc_bounds(spark: SparkSession, url: str, table: str, column: str,
                properties: dict | None = None) -> tuple:
    """min/max of ``column``, computed by the database (one small query)."""
    if not column.replace("_", "").isalnum():
        raise ValueError(f"bad column name {column!r}")
    if not table.replace("_", "").replace(".", "").isalnum():
        raise ValueError(f"bad table name {table!r}")
    query = f"(SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}) b"
    row = read_jdbc(spark, url, query, properties=properties).first()
    return row[0], row[1]
