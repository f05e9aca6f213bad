"""Physical-plan checks: no Python in any query plan, pruning where promised."""

import pytest

import __spark_entry__ as entry_mod
from tessera import operators as O
from tessera import sources as S
from tessera.queries import QUERIES, erase_requests, orders_by_priority, table
from tests.conftest import SF_SMALL

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
                "MapInPandas", "PythonUDF", "MapInArrow")


def plan_text(df):
    """The formatted explain text (what ``df.explain("formatted")`` prints)."""
    jvm = df.sparkSession.sparkContext._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_in_plan(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    text = plan_text(df)
    assert not any(n in text for n in PYTHON_NODES), text


def test_locate_prunes_partitions(spark):
    name = orders_by_priority(spark, SF_SMALL)
    df = O.locate_records(S.read_table(spark, name), erase_requests(spark, SF_SMALL),
                          "o_orderkey", "o_orderpriority")
    text = plan_text(df)
    assert "PartitionFilters: [o_orderpriority" in text and "IN (1-URGENT,5-LOW)" in text


def test_projection_reaches_scan(spark):
    df = entry_mod.queries()["join_inner"](spark, SF_SMALL).select(
        "o_orderkey", "o_custkey", "o_totalprice")
    text = plan_text(df)
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double>" in text


def test_group_sum_aggregates_before_shuffle(spark):
    df = O.group_sum(table(spark, SF_SMALL, "lineitem"), "l_returnflag", "l_quantity")
    assert "partial_sum" in plan_text(df)


def test_filter_pushed_to_scan(spark):
    c = table(spark, SF_SMALL, "customer").where("c_mktsegment = 'BUILDING'")
    assert "PushedFilters: [IsNotNull(c_mktsegment), EqualTo(c_mktsegment,BUILDING)]" in plan_text(c)


def test_short_key_list_reaches_parquet_reader(spark):
    name = orders_by_priority(spark, SF_SMALL)
    req = spark.createDataFrame([(5, "1-URGENT"), (9, "5-LOW")], "o_orderkey long, o_orderpriority string")
    df = O.locate_records(S.read_table(spark, name), req, "o_orderkey", "o_orderpriority")
    text = plan_text(df)
    assert "PushedFilters: [In(o_orderkey" in text or "In(o_orderkey, [5,9])" in text, text


def test_erase_reads_only_touched_partitions(spark):
    """The erase's scan of a batch carries its partitions as PartitionFilters."""
    from tessera.operators import erase as E
    name = orders_by_priority(spark, SF_SMALL)
    text = plan_text(E._Table(spark, name, None).batch(["1-URGENT", "5-LOW"]))
    assert "PartitionFilters: [" in text and "1-URGENT" in text and "5-LOW" in text
    assert "2-HIGH" not in text
