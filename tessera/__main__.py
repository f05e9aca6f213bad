"""Run a job from a ``key=value`` configuration file, as the original jobs were
run: ``python -m tessera <job> <config.properties>`` (or a two-line script
calling ``tessera.__main__.main`` through ``spark-submit``).

Jobs: ``generate``, ``split``, ``read``, ``stage``, ``erase``, ``jdbc``.  Keys
are those of the original configuration files; a few keys are ours and
optional (``seed``, ``split.key``, ``erase.key``, ``erase.swap``,
``jdbc.partition.column``, ``jdbc.num.partitions``).  The JDBC
password is taken from the environment variable ``TESSERA_JDBC_PASSWORD`` when
set, and is never printed.
"""

from __future__ import annotations

import json
import os
import sys

from pyspark.sql import SparkSession

from tessera.config import ConfigError, GeneratorConfig, load_properties
from tessera.operators.erase import erase_records
from tessera.operators.stages import add_one
from tessera.plans.flow import JOIN_NAMES, FlowSpec, run_flow
from tessera.plans.jobs import SplitConfig, StorageConfig, generate_job, read_job, split_job
from tessera.plans.workloads import jdbc_ingest
from tessera.sinks.writers import write_file
from tessera.sources.files import read_files

JOBS = ("generate", "split", "read", "stage", "erase", "jdbc")


def _session(props: dict[str, str]) -> SparkSession:
    b = SparkSession.builder.appName("tessera")
    if props.get("hive.support", "false").lower() == "true":
        b = b.enableHiveSupport()
    return b.getOrCreate()


def _input(spark: SparkSession, props: dict[str, str], file_key: str, db_key: str,
           table_key: str):
    if props.get("storage", "file") == "db" and db_key in props and table_key in props:
        return spark.table(f"{props[db_key]}.{props[table_key]}")
    if file_key not in props:
        raise ConfigError(f"missing {file_key}")
    return read_files(spark, props.get("format", "parquet"), props[file_key])


def _dealt(df, props):
    """The input dealt to ``workload.repartition`` tasks where that key is
    given.  ``spark.parallel.threads`` does not: the shipped value 2 would send
    any input through two tasks."""
    n = props.get("workload.repartition")
    return df.repartition(int(n)) if n else df


def run(job: str, props: dict[str, str], spark: SparkSession | None = None) -> dict:
    """Run one job; returns a small summary (counts, not data)."""
    if job not in JOBS:
        raise ConfigError(f"unknown job {job!r}; expected one of {JOBS}")
    spark = spark or _session(props)
    if job == "generate":
        cfg = GeneratorConfig.from_properties(props)
        if "seed" in props:
            from dataclasses import replace
            cfg = replace(cfg, seed=int(props["seed"]))
        target = StorageConfig.from_properties(props)
        return {"rows": generate_job(spark, cfg, target)}
    if job == "split":
        src = _dealt(_input(spark, props, "input.file.name", "input.db.name",
                              "input.table.name"), props)
        target = StorageConfig.from_properties(props, path_key="output.file.name",
                                               db_key="output.db.name",
                                               table_key="output.table.name")
        _, _, n = split_job(src, SplitConfig.from_properties(props),
                            props.get("split.key", "NIN"), target)
        return {"rows": n}
    if job == "read":
        storage = props.get("storage", "file")
        if storage == "db":
            rep = read_job(spark, "BENEFITS", table=f"{props['db.name']}.{props['table.name']}",
                           repartition=int(props.get("workload.repartition", 0)) or None)
        else:
            rep = read_job(spark, "BENEFITS", fmt=props.get("format", "csv"),
                           path=props["input.file.name"],
                           repartition=int(props.get("workload.repartition", 0)) or None)
        return {"rows": rep.rows, "seconds": round(rep.seconds, 3)}
    if job == "stage":
        fmt = props.get("format", "csv")
        base = _dealt(read_files(spark, fmt, props["input.file.name"]), props)
        other = _dealt(read_files(spark, fmt, props["input.file.name.join"]), props)
        part = props.get("partition.field.name") \
            if props.get("partitioned", "false").lower() == "true" else None
        out = props.get("output.file.name")
        res = run_flow(add_one(base, "BENEFITS"), other, props.get("stage.flow", "WRITE:"),
                       write=(lambda df: write_file(df, out, fmt, partition_by=part)),
                       spec=FlowSpec(join_names=JOIN_NAMES, right_prefix=None))
        return {"steps": [[s, round(t, 3)] for s, t in res.timings]}
    if job == "erase":
        rep = erase_records(spark, props["main.table"], spark.table(props["gdpr.table"]),
                            key=props.get("erase.key", "nin"),
                            part=props.get("partitioning.column"),
                            swap=props.get("erase.swap", "relocate"))
        return {"touched_rows": rep.touched_rows, "erased_rows": rep.erased_rows,
                "kept_rows": rep.kept_rows, "emptied": rep.emptied, "resumed": rep.resumed}
    # jdbc: the read test of the original (write mode was never implemented there)
    options = {"user": props.get("db.username", "")}
    password = os.environ.get("TESSERA_JDBC_PASSWORD", props.get("db.password"))
    if password:
        options["password"] = password
    parts = props.get("jdbc.num.partitions")
    rep = jdbc_ingest(spark, "jdbc:postgresql:" + props["db.server.jdbc.url"],
                      props["db.table.name"], "BENEFITS", props["output.file.name"],
                      props.get("format", "csv"),
                      partition_column=props.get("jdbc.partition.column"),
                      num_partitions=int(parts) if parts else None, properties=options)
    return {"rows": rep.rows}


def main(argv: list[str] | None = None) -> int:
    argv = sys.argv[1:] if argv is None else argv
    if len(argv) != 2:
        print(f"usage: python -m tessera <{'|'.join(JOBS)}> <config.properties>", file=sys.stderr)
        return 2
    job, path = argv
    print(json.dumps(run(job, load_properties(path))))
    return 0


if __name__ == "__main__":
    sys.exit(main())
