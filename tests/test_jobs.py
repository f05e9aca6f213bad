"""The original jobs as functions, driven by properties text."""

import pytest

from tessera.config import GeneratorConfig, parse_properties
from tessera.plans.jobs import SplitConfig, StorageConfig, generate_job, read_job, split_job
from tessera.session import scratch_database, scratch_path, unique_name
from tessera.sources import read_parquet


def test_generate_job_to_partitioned_files(spark):
    path = scratch_path(spark, "gen")
    n = generate_job(spark, GeneratorConfig(), StorageConfig(path=path, partitioned=True))
    assert n == 1440
    back = read_parquet(spark, path)
    assert back.count() == 1440
    assert back.select("PARTITIONER").distinct().count() == 20


def test_generate_job_to_table_casts_date(spark):
    name = f"{scratch_database(spark)}.{unique_name('g')}"
    generate_job(spark, GeneratorConfig(initial_count=1, outer_iterations1=1,
                                        outer_iterations2=0),
                 StorageConfig(storage="db", table=name))
    t = spark.table(name)
    assert t.count() == 2 and dict(t.dtypes)["DATE"] == "timestamp"


def test_storage_from_properties():
    props = parse_properties("storage=db\nformat=parquet\ndb.name=default\n"
                             "table.name=mainpii_partitioned\npartitioned=true\n"
                             "partition.field.name=PARTITIONER\n")
    cfg = StorageConfig.from_properties(props)
    assert cfg.table == "default.mainpii_partitioned" and cfg.partitioned
    with pytest.raises(ValueError):
        from tessera.plans.jobs import store
        store(None, StorageConfig(storage="tape", path="x"))


def test_split_job_modes(spark):
    from tessera.operators.generate import generate_records
    df = generate_records(spark)
    props = parse_properties("split.ratio=0.1\nsplit.record.number=2\n"
                             "split.partitioner.number=11\npartition.field.name=PARTITIONER\n")
    cfg = SplitConfig.from_properties(props)
    train, test, n = split_job(df, cfg, "NIN")
    assert train is None and test.count() == 2
    assert {r.PARTITIONER for r in test.collect()} == {"11"}
    path = scratch_path(spark, "split")
    train, test, n = split_job(df, SplitConfig(ratio=0.1), "NIN", StorageConfig(path=path))
    assert n == read_parquet(spark, path).count() and train.count() + n == 1440


def test_read_job(spark):
    path = scratch_path(spark, "r")
    generate_job(spark, GeneratorConfig(), StorageConfig(path=path, format="csv"))
    rep = read_job(spark, "BENEFITS", fmt="csv", path=path, repartition=2)
    assert rep.rows == 1440
    assert rep.frame.agg({"BENEFITS": "min"}).first()[0] >= 1.0


def test_run_sql_file(spark):
    import os
    import tempfile

    from tessera.plans.workloads import run_sql_file
    folder = tempfile.mkdtemp(prefix="tessera-sql-")
    path = os.path.join(folder, "q.sql")
    with open(path, "w") as fh:
        fh.write("SELECT count(*) AS n\nFROM t\nWHERE id >= :lo;\n")
    out = run_sql_file(spark, path, {"t": spark.range(10)}, args={"lo": 4})
    assert out.first().n == 6


def test_io_generated_writes_one_file_per_task_without_shuffle(spark):
    from tessera.plans.workloads import io_generated
    rep = io_generated(spark, scratch_path(spark, "io"), n_files=4, rows_per_file=2500)
    rows = rep.files.collect()
    assert len(rows) == 4 and all(r.row_count == 2500 for r in rows)
    assert rep.total_rows == 10000 and rep.total_bytes > 0 and rep.write_mb_per_sec > 0
