"""Stage flows: parser, fan-out semantics, the shipped flow texts."""

import pytest
from pyspark.sql import functions as F

from tessera.operators.generate import generate_records
from tessera.operators.split import split_by_hash
from tessera.plans.flow import FlowSpec, Step, parse_flow, run_flow

FLOWS = ["WRITE:", "GROUP:NIN", "GROUP:PARTITIONER, WRITE:", "JOIN:ADDRESS", "JOIN:NIN, WRITE:",
         "CUBE:PARTITIONER", "GROUP:NIN, JOIN:ADDRESS, CUBE:NIN, WRITE:"]


def test_parse():
    assert parse_flow(" group:NIN , Join:ADDRESS,CUBE:NIN, WRITE:") == [
        Step("GROUP", "NIN"), Step("JOIN", "ADDRESS"), Step("CUBE", "NIN"), Step("WRITE")]
    with pytest.raises(ValueError):
        parse_flow("SORT:NIN")
    with pytest.raises(ValueError):
        parse_flow("GROUP:")


@pytest.fixture(scope="module")
def inputs(spark):
    base = generate_records(spark, n=1440)
    _, sample = split_by_hash(base, "NIN", 0.1)
    return base.withColumn("BENEFITS", F.col("BENEFITS") + 1), sample


@pytest.mark.parametrize("flow", FLOWS)
def test_shipped_flows_run(spark, inputs, flow):
    base, other = inputs
    written = []
    res = run_flow(base, other, flow, write=written.append)
    assert len(res.timings) == len(parse_flow(flow))
    if flow.endswith("WRITE:"):
        assert written and written[0] is res.last


def test_fan_out_semantics(spark, inputs):
    base, other = inputs
    written = []
    res = run_flow(base, other, "GROUP:NIN, JOIN:ADDRESS, CUBE:NIN, WRITE:", write=written.append,
                   execute=False)
    # the written frame is the CUBE over the base (gid + avg + max)
    assert set(written[0].columns) == {"NIN", "ADDRESS", "gid", "avg(BENEFITS)", "max(BALANCE)"}
    # a 9+9 column join with one shared key -> 17 columns, positional rename works
    spec = FlowSpec(join_names=tuple(f"newCol{i}" for i in range(1, 18)))
    joined = run_flow(base, other, "JOIN:NIN", spec=spec, execute=False).last
    assert len(joined.columns) == 17 and joined.count() == other.count()
    # WRITE first writes the base; WRITE:x writes the base too
    w2 = []
    run_flow(base, other, "GROUP:NIN, WRITE:x", write=w2.append, execute=False)
    assert w2[0] is base


def test_group_sum_matches_manual(spark, inputs):
    base, other = inputs
    res = run_flow(base, other, "GROUP:PARTITIONER", execute=False).last
    total = res.agg(F.sum("sum(BENEFITS)")).first()[0]
    assert abs(total - base.agg(F.sum("BENEFITS")).first()[0]) < 1e-6


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("flow", ["JOIN:NIN, WRITE:", "JOIN:NIN, CUBE:NIN, WRITE:, WRITE:"])
def test_a_step_that_is_written_runs_once(spark, inputs, flow):
    base, other = inputs
    written = []
    spec = FlowSpec(avg_digits=6)
    res = run_flow(base, other, flow, write=written.append, spec=spec)
    assert not any(op in _plan(df) for df in written for op in ("Join", "Aggregate", "Expand"))
    assert all(df is res.last for df in written)
    whole = run_flow(base, other, flow.split(", WRITE")[0], spec=spec, execute=False).last
    assert res.last.dtypes == whole.dtypes
    assert res.last.exceptAll(whole).isEmpty() and whole.exceptAll(res.last).isEmpty()


def test_a_result_that_parquet_cannot_hold_is_not_stored(spark, inputs):
    base, other = inputs
    written = []
    run_flow(base, other, "JOIN:NIN, WRITE:", write=written.append, spec=FlowSpec(right_prefix=None))
    assert len(written[0].columns) == 17 and "Join" in _plan(written[0])
    run_flow(base, other, "JOIN:NIN, WRITE:x", write=written.append)
    assert written[1].columns == base.columns
