"""Erase on a partitioned file dataset (no catalog)."""

import tempfile

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tessera.operators import erase as E
from tessera.session import scratch_path
from tests.test_erase_golden import CITIZENS, reqs

SCHEMA = StructType([StructField("nin", LongType()), StructField("name", StringType()),
                     StructField("dob", StringType())])


def make_path(spark, rows=CITIZENS):
    path = scratch_path(spark, "citizens_path")
    spark.createDataFrame(rows, SCHEMA).write.partitionBy("dob").parquet(path)
    return path


def read(spark, path):
    return spark.read.schema(SCHEMA).parquet(path)


@pytest.mark.parametrize("swap", ["copy", "files"])
def test_golden_on_path(spark, swap):
    path = make_path(spark)
    r = reqs(spark, [(30234324, "Andy", "1960"), (30234323, "Peter", "1950")])
    rep = E.erase_records_path(spark, path, r, "nin", "dob", schema=SCHEMA, swap=swap)
    assert rep.erased_rows == 2 and read(spark, path).count() == 10


@pytest.mark.parametrize("swap", ["copy", "files"])
def test_emptied_folder_removed_and_leading_zeros_kept(spark, swap):
    rows = [(1, "a", "007"), (2, "b", "007"), (3, "c", "010")]
    path = make_path(spark, rows)
    r = reqs(spark, [(1, "a", "007"), (2, "b", "007")])
    rep = E.erase_records_path(spark, path, r, "nin", "dob", schema=SCHEMA, swap=swap)
    assert rep.emptied == ["007"]
    back = read(spark, path).collect()
    assert [(x.nin, x.dob) for x in back] == [(3, "010")]


@pytest.mark.parametrize("swap", ["copy", "files"])
def test_path_crash_resumes(spark, swap):
    path = make_path(spark)
    r = reqs(spark, [(30234324, "Andy", "1960")])
    with pytest.raises(RuntimeError):
        E.erase_records_path(spark, path, r, "nin", "dob", schema=SCHEMA,
                             fail_after_staging=True, swap=swap)
    assert read(spark, path).count() == 12
    rep = E.erase_records_path(spark, path, reqs(spark, []), "nin", "dob", schema=SCHEMA)
    assert rep.resumed and read(spark, path).count() == 11


@pytest.mark.parametrize("swap", ["copy", "files"])
def test_path_values_with_spaces_and_symbols(spark, swap):
    rows = [(1, "a", "4-NOT SPECIFIED"), (2, "b", "4-NOT SPECIFIED"), (3, "c", "x/y=z%")]
    path = make_path(spark, rows)
    r = reqs(spark, [(1, "a", "4-NOT SPECIFIED"), (3, "c", "x/y=z%")])
    rep = E.erase_records_path(spark, path, r, "nin", "dob", schema=SCHEMA, swap=swap)
    assert rep.erased_rows == 2 and rep.emptied == ["x/y=z%"]
    assert [(x.nin, x.dob) for x in read(spark, path).collect()] == [(2, "4-NOT SPECIFIED")]


def test_one_partition_of_very_many_files(spark, monkeypatch):
    """File names reach neither the plans nor the marker, and the driver's
    Python holds a chunk of them at a time."""
    import json
    import os
    import tracemalloc

    from tessera.operators import file_lists as L
    n = 20_000
    root = tempfile.mkdtemp(prefix="tessera-many-")
    os.makedirs(f"{root}/dob=1960")
    os.makedirs(f"{root}/dob=1999")
    for i in range(n):
        with open(f"{root}/dob=1960/part-{i:05d}-{'x' * 60}.json", "w") as f:
            f.write(json.dumps({"nin": i // 2, "name": "n"}) + "\n")
    with open(f"{root}/dob=1999/part-0.json", "w") as f:
        f.write('{"nin": 1, "name": "other"}\n')
    plans, markers = [], []
    real = E._stage_survivors
    monkeypatch.setattr(E, "_stage_survivors", lambda target, rows, *a: (
        plans.append(rows._jdf.queryExecution().toString()), real(target, rows, *a))[1])
    write = E.fsutil.write_text
    monkeypatch.setattr(E.fsutil, "write_text", lambda s, path, text: (
        markers.append(len(text)), write(s, path, text))[1])
    monkeypatch.setattr(E, "MAX_FILE_LITERALS", 100)
    monkeypatch.setattr(L, "CHUNK", 2_000)
    requests = spark.createDataFrame([(i, "1960") for i in range(200)] + [(1, "2000")], "nin bigint, dob string")
    tracemalloc.start()
    report = E.erase_records_path(spark, root, requests, "nin", "dob", fmt="json", swap="files",
                                  schema=SCHEMA)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (report.touched_rows, report.erased_rows, report.kept_rows) == (n, 400, n - 400)
    assert peak < 4_000_000 and max(markers) < 4_000 and "x" * 60 not in plans[0]
    left = os.listdir(f"{root}/dob=1960")
    assert len([f for f in left if f.endswith(".json") and not f.startswith(".")]) == n - 400
    got = spark.read.schema(SCHEMA).json(root)
    assert got.count() == n - 400 + 1 and got.where("nin < 200 and dob = '1960'").count() == 0


@pytest.mark.parametrize("swap", ["copy", "files"])
@pytest.mark.parametrize("step", ["staged", "half-swapped", "swapped", "verified", "half-deleted"])
def test_long_lists_are_compared_by_joins(spark, monkeypatch, swap, step):
    from tessera.operators import file_lists as L
    monkeypatch.setattr(L, "SMALL", 0)
    monkeypatch.setattr(L, "CHUNK", 2)
    monkeypatch.setattr(E, "MAX_FILE_LITERALS", 0)
    path = make_path(spark)
    requests = spark.createDataFrame([(30234324, "1960"), (30234323, "1950")], "nin bigint, dob string")
    with pytest.raises(RuntimeError, match="test hook"):
        E.erase_records_path(spark, path, requests, "nin", "dob", schema=SCHEMA, swap=swap, stop_at=step)
    report = E.erase_records_path(spark, path, requests.limit(0), "nin", "dob", schema=SCHEMA, swap=swap)
    assert report.resumed
    assert sorted(r.nin for r in read(spark, path).collect()) == sorted(
        c[0] for c in CITIZENS if c[0] not in (30234324, 30234323))
