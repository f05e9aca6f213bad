"""The queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import (
    bpe_codec, decontaminate, hard_negatives, language_id, license_scan, line_dedup, quality_rules,
    ranked_search, simhash, substring_dedup, token_count, toxicity, url_filter,
)

TOKENIZER = "byte_bpe_50k.json"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_token_counts(spark, sf):
    return token_count.count_tokens(table(spark, sf, "documents"),
                                    public_tokenizers.path(TOKENIZER))


def op2_line_dedup(spark, sf):
    return (line_dedup.dedup_lines(table(spark, sf, "documents"))
            .select("doc_id", "text", "n_lines", "n_removed"))


def op3_quality_rules(spark, sf):
    return quality_rules.judge(table(spark, sf, "documents")).drop("k1", "k2")


def op4_bpe_codec(spark, sf):
    return bpe_codec.digests(table(spark, sf, "documents"), public_tokenizers.path(TOKENIZER))


def op5_simhash(spark, sf):
    return simhash.near_duplicates(table(spark, sf, "documents"), shingle_words=3, max_bits=2)


def op6_language_id(spark, sf):
    return language_id.languages_of(table(spark, sf, "documents"), table(spark, sf, "pages"))


def op7_license_scan(spark, sf):
    return license_scan.license_labels(table(spark, sf, "documents"))


def op8_decontaminate(spark, sf):
    return (decontaminate.contaminated(table(spark, sf, "documents"),
                                       table(spark, sf, "benchmark"))
            .withColumnRenamed("id", "doc_id").drop("k1", "k2"))


def op9_url_filter(spark, sf):
    return url_filter.judge_urls(table(spark, sf, "pages"))


def op10_toxicity(spark, sf):
    return toxicity.severity(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op11_ranked_search(spark, sf):
    return ranked_search.rank(table(spark, sf, "documents"), table(spark, sf, "benchmark"), k=10)


def op12_substring_dedup(spark, sf):
    return substring_dedup.without_repeats(table(spark, sf, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op13_hard_negatives(spark, sf):
    rows = table(spark, sf, "embeddings").withColumn("label", F.when(
        F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_line_dedup": op2_line_dedup,
    "op3_quality_rules": op3_quality_rules,
    "op4_bpe_codec": op4_bpe_codec,
    "op5_simhash": op5_simhash,
    "op6_language_id": op6_language_id,
    "op7_license_scan": op7_license_scan,
    "op8_decontaminate": op8_decontaminate,
    "op9_url_filter": op9_url_filter,
    "op10_toxicity": op10_toxicity,
    "op11_ranked_search": op11_ranked_search,
    "op12_substring_dedup": op12_substring_dedup,
    "op13_hard_negatives": op13_hard_negatives,
}
