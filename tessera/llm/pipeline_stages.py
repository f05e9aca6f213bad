"""The stages of ``corpus_pipeline``: functions of (spark, docs, sf_dir)."""

from __future__ import annotations

import public_tokenizers

from pyspark.sql import functions as F

from tessera.llm import bpe_codec as codec
from tessera.llm import decontaminate
from tessera.llm import line_dedup as lines
from tessera.llm import quality_rules as quality
from tessera.llm import simhash
from tessera.llm.common import materialize, row_key, text_or_empty, without_rows

TOKENIZER = "byte_bpe_50k.json"


def quality_rules(spark, docs, sf_dir):
    """Documents that the quality rules keep."""
    gone = materialize(quality.judge(docs).where("not kept").select("k1", "k2").distinct(),
                       "pipeline-rejected")
    key = row_key(F.struct("doc_id", "lang", "source"), text_or_empty("text"))
    return without_rows(docs, key, gone)


def line_dedup(spark, docs, sf_dir):
    """Every document, freed of repeated passages; ``n_chars`` follows."""
    return (lines.dedup_lines(docs).withColumn("n_chars", F.length("text").cast("long"))
            .select(*docs.columns))


def simhash_near_dedup(spark, docs, sf_dir):
    """One document of each group of near copies."""
    return simhash.keep_one(docs, shingle_words=3, max_bits=2)


def benchmark_decontamination(spark, docs, sf_dir):
    """Documents in which no benchmark item is found."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.without_contaminated(docs, benchmark)


def bpe_codec(spark, docs, sf_dir):
    return codec.digests(docs, public_tokenizers.path(TOKENIZER))
