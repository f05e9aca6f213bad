"""The queries of the subpackage and the pipeline."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tessera.llm import queries
from tests.conftest import SF_ORACLE, SF_SMALL
from tests.llm import test_line_dedup, test_quality_rules, test_simhash
from tests.llm.rows import edge_frame, empty_frame
from tests.oracle_compare import compare, duck


@pytest.mark.parametrize("name", sorted(n for n in entry.oracle_sql() if n in queries.QUERIES))
def test_query_matches_oracle(spark, name):
    con = duck(SF_ORACLE)
    problems, _ = compare(entry.queries()[name](spark, SF_ORACLE), con, entry.oracle_sql()[name])
    con.close()
    assert not problems


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_runs(spark, name):
    df = queries.QUERIES[name](spark, SF_SMALL)
    assert df.count() > 0
    assert not {"k1", "k2"} & set(df.columns)


def test_every_operator_has_one_query():
    numbers = sorted(int(n[2:].split("_")[0]) for n in entry.queries() if n.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in entry.queries()


def test_stages_by_brute_force(spark):
    """The first three stages against the brute forces of their operators."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["quality_rules"](spark, docs, SF_SMALL)
    assert kept.columns == docs.columns
    rows = {r.doc_id: r for r in docs.collect()}
    clean = {r.doc_id for r in kept.collect()}
    for i, r in rows.items():
        n, _, _, _, repeats = test_quality_rules.brute(r.text)
        if n < 20 or 100 * repeats > 30 * n:
            assert i not in clean
    freed = stages["line_dedup"](spark, kept, SF_SMALL)
    assert freed.columns == docs.columns
    want = {i: t for i, t, _, _ in test_line_dedup.brute(
        [(r.doc_id, r.text) for r in kept.collect()])}
    got = {r.doc_id: r for r in freed.collect()}
    assert {i: r.text for i, r in got.items()} == want
    assert all(r.n_chars == len(r.text) for r in got.values())
    one = stages["simhash_near_dedup"](spark, freed, SF_SMALL)
    ids = sorted(got)
    roots = test_simhash.group([test_simhash.fingerprint(got[i].text) for i in ids],
                               lambda a, b: (a ^ b).bit_count() <= 2)
    assert sorted(r.doc_id for r in one.collect()) == [ids[r] for r in sorted(set(roots))]


def test_run(spark):
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert 50 < out.count() < 200


def test_stages_take_edge_rows_and_empty_tables(spark):
    for docs in (edge_frame(spark), empty_frame(spark)):
        docs = docs.withColumn("extra", F.lit("k1"))
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF_SMALL)
            out.write.format("noop").mode("overwrite").save()
            if name != "bpe_codec":
                assert out.columns == docs.columns
