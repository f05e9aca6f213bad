"""Training-data pipeline over ``documents``: the stages in order, each over
all rows that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import pipeline_stages as S
from tessera.llm.common import settled

STAGES = [
    ("quality_rules", S.quality_rules),
    ("line_dedup", S.line_dedup),
    ("simhash_near_dedup", S.simhash_near_dedup),
    ("benchmark_decontamination", S.benchmark_decontamination),
    ("bpe_codec", S.bpe_codec),
]

# Robust estimates, components and alignments have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage.  What the others leave under
    ``spark.checkpoint.dir`` is their results; their scratch tables go."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settled(spark, lambda s=stage, d=docs: s(spark, d, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
