"""Synthetic records of the main 9-column schema, generated on executors.

Rows come from ``spark.range`` (or any id column), so nothing is built on the
driver and the row count only sets the size of the range.  Column values are
seeded hashes of the row id (see ``tessera.functions.random``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType, DoubleType, IntegerType, StringType, StructField, StructType,
)

from tessera.config import GeneratorConfig
from tessera.functions import random as R

RECORD_SCHEMA = StructType([
    StructField("NIN", StringType(), True),
    StructField("NAME", StringType(), True),
    StructField("BENEFITS", DoubleType(), True),
    StructField("ADDRESS", StringType(), True),
    StructField("BALANCE", DoubleType(), True),
    StructField("ACC_NAME", StringType(), True),
    StructField("CODE", IntegerType(), True),
    StructField("PARTITIONER", StringType(), True),
    StructField("DATE", DateType(), True),
])


_LETTER_COLUMNS = (("ADDRESS", "address_len"), ("ACC_NAME", "accname_len"))


def record_columns(id_col, cfg: GeneratorConfig, chunks: dict | None = None) -> list:
    """The nine column expressions for row id ``id_col``.

    ``chunks`` maps a letter column to its precomputed chunk columns (see
    ``records_for_ids``); without it the letters are computed inline.
    """
    s = cfg.seed

    def text(name: str, length: int):
        if chunks and name in chunks:
            return R.letters_from_chunk_columns(chunks[name], length)
        return R.letters(s, name, id_col, length)

    return [
        R.uuid4_text(s, "NIN", id_col).alias("NIN"),
        R.uuid4_text(s, "NAME", id_col).alias("NAME"),
        R.uniform_double(s, "BENEFITS", id_col).alias("BENEFITS"),
        text("ADDRESS", cfg.address_len).alias("ADDRESS"),
        R.uniform_double(s, "BALANCE", id_col).alias("BALANCE"),
        text("ACC_NAME", cfg.accname_len).alias("ACC_NAME"),
        R.uniform_int(s, "CODE", id_col, cfg.code_range).alias("CODE"),
        R.uniform_int(s, "PARTITIONER", id_col, cfg.partitions).cast("string").alias("PARTITIONER"),
        R.day_in_range(s, "DATE", id_col, cfg.start, cfg.end).alias("DATE"),
    ]


def records_for_ids(ids: DataFrame, id_col: str, cfg: GeneratorConfig = GeneratorConfig(),
                    keep_id: bool = False, spread: int | None = None) -> DataFrame:
    """One record per row of ``ids``; the record is a function of the id only.

    Three narrow projections (digests -> 52-bit chunks -> columns): each md5
    and each hex conversion runs once per row instead of once per letter.
    Nothing runs while this is built.  Generation is CPU-bound: for an id
    source of few partitions give ``spread``, and the ids (only they) are dealt
    round robin to that many tasks first; a large input needs none.
    """
    idc = F.col(id_col)
    if spread:
        ids = ids.select(idc).repartition(spread)
    digests = [R.letters_digest(cfg.seed, name, idc, getattr(cfg, attr)).alias(f"__{name}_d")
               for name, attr in _LETTER_COLUMNS]
    stage1 = ids.select(idc, *digests)
    chunk_cols = {}
    exprs = [F.col(id_col)]
    for name, attr in _LETTER_COLUMNS:
        cols = R.letter_chunks(F.col(f"__{name}_d"), getattr(cfg, attr))
        names = [f"__{name}_c{i}" for i in range(len(cols))]
        exprs += [c.alias(n) for c, n in zip(cols, names)]
        chunk_cols[name] = names
    stage2 = stage1.select(*exprs)
    out = record_columns(F.col(id_col), cfg, chunk_cols)
    if keep_id:
        out = [F.col(id_col)] + out
    return stage2.select(*out)


# About 0.2 KB per record: 4M records make a task of roughly 1 GB of output.
ROWS_PER_TASK = 4_000_000


def generate_records(spark: SparkSession, cfg: GeneratorConfig = GeneratorConfig(),
                     n: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """``n`` records (default ``cfg.record_count()``), ids 0..n-1.

    ``num_partitions`` only sets the task count (default: enough tasks for
    about ``ROWS_PER_TASK`` rows each, at least the default parallelism);
    rows are identical for any value.
    """
    n = cfg.record_count() if n is None else n
    if not num_partitions:
        num_partitions = max(spark.sparkContext.defaultParallelism,
                             -(-n // ROWS_PER_TASK))
    return records_for_ids(spark.range(0, n, 1, num_partitions), "id", cfg)


def replicate_rows(df: DataFrame, copies: int, copy_col: str = "copy") -> DataFrame:
    """Each row ``copies`` times, numbered 1..copies in ``copy_col`` (narrow:
    the copies are made inside the task that holds the row)."""
    if copies < 1:
        raise ValueError("copies must be >= 1")
    return df.withColumn(copy_col, F.explode(F.sequence(F.lit(1), F.lit(copies))))
