"""Composite jobs: stage flows, workloads (read, ingest, I/O, SQL text) and
run/stage metrics computed as Spark jobs."""

from tessera.plans.flow import (
    JOIN_NAMES, Step, FlowSpec, FlowResult, parse_flow, run_flow, step_frame,
)
from tessera.plans.workloads import (
    read_workload, ingest, jdbc_ingest, io_files, io_generated, run_sql, run_sql_file,
    sql_to_file,
    timed_noop,
)
from tessera.plans.jobs import (
    StorageConfig, SplitConfig, store, generate_job, split_job, read_job,
)
from tessera.plans.metrics import (
    SAMPLE_SCHEMA, run_summary, stage_metrics, stage_metrics_frame,
    job_group_metrics,
)

__all__ = [
    "JOIN_NAMES", "Step", "FlowSpec", "FlowResult", "parse_flow", "run_flow", "step_frame",
    "read_workload", "ingest", "jdbc_ingest", "io_files", "io_generated", "run_sql", "run_sql_file", "sql_to_file",
    "timed_noop", "SAMPLE_SCHEMA", "run_summary", "stage_metrics",
    "stage_metrics_frame", "job_group_metrics", "StorageConfig", "SplitConfig", "store", "generate_job",
    "split_job", "read_job",
]
