"""The jobs run from original-style configuration text."""

import os
import tempfile

from tessera.__main__ import main, run
from tessera.config import parse_properties
from tessera.session import scratch_database, scratch_path, unique_name


def props(text):
    return parse_properties(text)


def test_generate_split_stage_read_on_files(spark):
    gen = scratch_path(spark, "cli_gen")
    out = run("generate", props(f"""
        storage=file
        format=csv
        file.name={gen}
        partitioned=false
        initial.record.count1=5
        outer.iterations1=5
        inner.iterations1=2
        outer.iterations2=2
        inner.iterations2=3
        """), spark)
    assert out == {"rows": 1440}
    split = scratch_path(spark, "cli_split")
    out = run("split", props(f"""
        storage=file
        format=csv
        input.file.name={gen}
        output.file.name={split}
        split.ratio=0.1
        split.record.number=0
        spark.parallel.threads=2
        """), spark)
    assert 80 < out["rows"] < 220
    flow_out = scratch_path(spark, "cli_flow")
    out = run("stage", props(f"""
        format=csv
        input.file.name={gen}
        input.file.name.join={split}
        output.file.name={flow_out}
        stage.flow=GROUP:PARTITIONER, JOIN:ADDRESS, CUBE:PARTITIONER, WRITE:
        spark.parallel.threads=2
        """), spark)
    assert [s for s, _ in out["steps"]] == ["GROUP:PARTITIONER", "JOIN:ADDRESS",
                                            "CUBE:PARTITIONER", "WRITE:"]
    written = spark.read.option("header", True).csv(flow_out)
    assert "gid" in written.columns          # the CUBE result was written
    out = run("read", props(f"format=csv\ninput.file.name={gen}\nworkload.repartition=2\n"),
              spark)
    assert out["rows"] == 1440


def test_generate_split_erase_on_tables(spark):
    db = scratch_database(spark)
    main_t, req_t = unique_name("mainpii"), unique_name("pii_del")
    run("generate", props(f"""
        storage=db
        format=parquet
        db.name={db}
        table.name={main_t}
        partitioned=true
        partition.field.name=PARTITIONER
        file.partitions.number=20
        """), spark)
    run("split", props(f"""
        storage=db
        input.db.name={db}
        input.table.name={main_t}
        output.db.name={db}
        output.table.name={req_t}
        partitioned=true
        partition.field.name=PARTITIONER
        split.record.number=2
        split.partitioner.number=11
        """), spark)
    assert spark.table(f"{db}.{req_t}").count() == 2
    out = run("erase", props(f"""
        main.table={db}.{main_t}
        gdpr.table={db}.{req_t}
        partitioning.column=PARTITIONER
        erase.key=NIN
        """), spark)
    assert out["erased_rows"] == 2 and spark.table(f"{db}.{main_t}").count() == 1438


def test_main_usage_and_file(spark, capsys):
    assert main(["generate"]) == 2
    folder = tempfile.mkdtemp(prefix="tessera-cfg-")
    cfg = os.path.join(folder, "gen.properties")
    with open(cfg, "w") as fh:
        fh.write(f"storage=file\nformat=parquet\nfile.name={scratch_path(spark, 'cli_main')}\n"
                 "outer.iterations2=0\n")
    assert main(["generate", cfg]) == 0
    assert '"rows": 160' in capsys.readouterr().out
