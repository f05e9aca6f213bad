"""Golden erasure example and its edge cases (FIXTURES.md section 1)."""

import pytest
from pyspark.sql import functions as F

from tessera import fsutil
from tessera.operators import erase as E
from tessera.session import scratch_database, unique_name
from tessera.sources.catalog import list_partitions

CITIZENS = [
    (30234324, "Andy", "1960"), (30234323, "Peter", "1950"), (30234333, "Justin", "1940"),
    (30234328, "Rose", "1945"), (30234329, "Mary", "1940"), (30234332, "Sam", "1940"),
    (30231324, "Peter", "1960"), (30238323, "Jessy", "1950"), (30239333, "John", "1940"),
    (32234328, "Terry", "1945"), (30334329, "Gordon", "1940"), (30244332, "Lisa", "1940"),
]
SCHEMA = "nin bigint, name string, dob string"


def make_table(spark, rows=CITIZENS, external=False):
    db = scratch_database(spark)
    name = f"{db}.{unique_name('citizens')}"
    w = spark.createDataFrame(rows, SCHEMA).write.mode("overwrite").format("parquet").partitionBy("dob")
    if external:
        from tessera.session import scratch_path
        w = w.option("path", scratch_path(spark, "ext"))
    w.saveAsTable(name)
    return name


def reqs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def stored_keys(spark, table):
    """Keys in every data file under the table's folder, hidden ones too."""
    import os

    import pyarrow.parquet as pq
    loc = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").first()[1]
    out = []
    for folder, _, files in os.walk(loc.split(":", 1)[1] if loc.startswith("file:") else loc):
        for f in files:
            if f.endswith(".parquet"):
                out += pq.ParquetFile(os.path.join(folder, f)).read(["nin"])["nin"].to_pylist()
    return sorted(out)


def names(spark, table):
    return sorted(r.name for r in spark.table(table).collect())


@pytest.mark.parametrize("swap", ["relocate", "copy", "files"])
def test_golden_two_requests(spark, swap):
    t = make_table(spark)
    r = reqs(spark, [(30234324, "Andy", "1960"), (30234323, "Peter", "1950")])
    rep = E.erase_records(spark, t, r, key="nin", swap=swap)
    assert spark.table(t).count() == 10
    assert "Andy" not in names(spark, t)
    assert rep.touched_rows == 4 and rep.erased_rows == 2 and rep.kept_rows == 2
    assert sorted(rep.partitions) == ["1950", "1960"]


@pytest.mark.parametrize("swap", ["relocate", "copy", "files"])
def test_untouched_partitions_keep_files(spark, swap):
    t = make_table(spark)
    loc = spark.sql(f"DESCRIBE FORMATTED {t}").where("col_name = 'Location'").first()[1]

    def files(part):
        fs, p = fsutil._fs(spark, f"{loc}/dob={part}")
        return sorted((s.getPath().getName(), s.getModificationTime()) for s in fs.listStatus(p))

    before = {p: files(p) for p in ("1940", "1945")}
    E.erase_records(spark, t, reqs(spark, [(30234324, "Andy", "1960")]), key="nin", swap=swap)
    assert {p: files(p) for p in ("1940", "1945")} == before
    # the erased row's old files are gone from storage, not just from the catalog
    assert not fsutil.exists(spark, f"{loc}/dob=1960") or swap != "relocate"


@pytest.mark.parametrize("external", [False, True])
@pytest.mark.parametrize("swap", ["relocate", "copy", "files"])
def test_emptied_partition_is_dropped(spark, external, swap):
    t = make_table(spark, external=external)
    r = reqs(spark, [(30234328, "Rose", "1945"), (32234328, "Terry", "1945"),
                     (30234324, "Andy", "1960")])
    rep = E.erase_records(spark, t, r, key="nin", swap=swap)
    assert rep.emptied == ["1945"]
    assert spark.table(t).count() == 9
    parts = [x.partition_name for x in list_partitions(spark, t).collect()]
    assert "dob=1945" not in parts
    spark.catalog.refreshTable(t)
    assert spark.table(t).where("dob = '1945'").count() == 0


def test_key_in_other_listed_partition(spark):
    t = make_table(spark)
    r = reqs(spark, [(30234324, "x", "1950"), (1, "y", "1960")])
    E.erase_records(spark, t, r, key="nin")
    assert spark.table(t).count() == 11
    assert "Andy" not in names(spark, t)


def test_key_only_under_wrong_partition(spark):
    t = make_table(spark)
    E.erase_records(spark, t, reqs(spark, [(30234324, "x", "1950")]), key="nin")
    assert spark.table(t).count() == 12


def test_null_request_key(spark):
    t = make_table(spark)
    E.erase_records(spark, t, reqs(spark, [(30234324, "Andy", "1960"), (None, "n", "1950")]), key="nin")
    assert spark.table(t).count() == 11


def test_null_key_in_main(spark):
    t = make_table(spark, CITIZENS + [(None, "Nobody", "1960")])
    E.erase_records(spark, t, reqs(spark, [(30234324, "Andy", "1960")]), key="nin")
    assert spark.table(t).count() == 12
    assert "Nobody" in names(spark, t)


def test_empty_request_list(spark):
    t = make_table(spark)
    rep = E.erase_records(spark, t, reqs(spark, []), key="nin")
    assert rep.skipped and spark.table(t).count() == 12


def test_rerun_is_noop(spark):
    t = make_table(spark)
    r = reqs(spark, [(30234324, "Andy", "1960")])
    E.erase_records(spark, t, r, key="nin")
    rep = E.erase_records(spark, t, r, key="nin")
    assert rep.erased_rows == 0 and spark.table(t).count() == 11


STEPS = ["requests", "staged", "half-swapped", "swapped", "verified", "half-deleted", "deleted",
         "unmarked"]
ANDY, PETER, ROSE = (30234324, "Andy", "1960"), (30234323, "Peter", "1950"), (30234328, "Rose", "1945")


@pytest.mark.parametrize("swap,step", [
    *[("relocate", s) for s in STEPS], *[("copy", s) for s in STEPS], ("files", "staged"),
    ("files", "half-deleted")])
def test_after_a_crash_both_request_lists_are_erased(spark, swap, step):
    """Stopped anywhere, the next call ends the old list and runs its own."""
    t = make_table(spark)
    with pytest.raises(RuntimeError, match="test hook"):
        E.erase_records(spark, t, reqs(spark, [ANDY, (30231324, "Peter", "1960"), PETER]),
                        key="nin", swap=swap, stop_at=step)
    rep = E.erase_records(spark, t, reqs(spark, [ROSE]), key="nin", swap=swap)
    assert rep.resumed
    assert sorted(r.nin for r in spark.table(t).collect()) == sorted(
        c[0] for c in CITIZENS if c[0] not in (30234324, 30231324, 30234323, 30234328))
    assert stored_keys(spark, t) == sorted(r.nin for r in spark.table(t).collect())
    rep = E.erase_records(spark, t, reqs(spark, []), key="nin")
    assert not rep.resumed


@pytest.mark.parametrize("swap,step", [
    ("relocate", "staged"), ("relocate", "half-swapped"), ("relocate", "swapped"),
    ("relocate", "verified"), ("copy", "staged"), ("copy", "half-swapped"), ("copy", "swapped"),
    ("copy", "verified"), ("files", "staged"), ("files", "swapped")])
def test_rows_appended_after_a_crash_stay(spark, swap, step):
    t = make_table(spark)
    with pytest.raises(RuntimeError, match="test hook"):
        E.erase_records(spark, t, reqs(spark, [ANDY, PETER]), key="nin", swap=swap, stop_at=step)
    new = [(1, "New", "1960"), (2, "New", "1950"), (3, "New", "1999")]
    spark.createDataFrame(new, SCHEMA).write.insertInto(t)
    spark.catalog.refreshTable(t)
    E.erase_records(spark, t, reqs(spark, [ROSE]), key="nin", swap=swap)
    want = sorted([c[0] for c in CITIZENS if c[0] not in (30234324, 30234323, 30234328)] + [1, 2, 3])
    assert sorted(r.nin for r in spark.table(t).collect()) == want
    assert stored_keys(spark, t) == want


@pytest.mark.parametrize("swap", ["relocate", "copy", "files"])
def test_replaced_files_are_not_deleted_by_a_resume(spark, swap):
    """Between crash and resume the partition was rewritten by another job."""
    t = make_table(spark)
    with pytest.raises(RuntimeError, match="test hook"):
        E.erase_records(spark, t, reqs(spark, [ANDY]), key="nin", swap=swap, stop_at="staged")
    rows = spark.createDataFrame([(30234324, "Andy"), (7, "Seven")], "nin bigint, name string")
    rows.createOrReplaceTempView("replaced_rows")
    spark.sql(f"INSERT OVERWRITE TABLE {t} PARTITION (dob = '1960') SELECT * FROM replaced_rows")
    E.erase_records(spark, t, reqs(spark, []), key="nin", swap=swap)
    assert sorted(r.name for r in spark.table(t).where("dob = '1960'").collect()) == ["Seven"]
    assert spark.table(t).count() == len(CITIZENS) - 2 + 1


@pytest.mark.parametrize("swap,fmt,options", [
    ("relocate", "csv", {"header": "true", "sep": "|"}), ("copy", "csv", {}), ("files", "csv", {}),
    ("relocate", "json", {}), ("files", "json", {})])
def test_tables_keep_their_format(spark, fmt, options, swap):
    t = f"{scratch_database(spark)}.{unique_name('text_table')}"
    (spark.createDataFrame(CITIZENS, SCHEMA).write.format(fmt).options(**options)
     .partitionBy("dob").saveAsTable(t))
    E.erase_records(spark, t, reqs(spark, [ANDY, PETER]), key="nin", swap=swap)
    assert sorted(map(tuple, spark.table(t).collect())) == sorted(
        c for c in CITIZENS if c[0] not in (30234324, 30234323))


def test_what_cannot_be_erased_from_is_rejected_first(spark):
    db = scratch_database(spark)
    two, text = f"{db}.{unique_name('two')}", f"{db}.{unique_name('text')}"
    spark.range(4).selectExpr("id nin", "id % 2 a", "id % 3 b").write.partitionBy("a", "b").saveAsTable(two)
    with pytest.raises(ValueError):
        E.erase_records(spark, two, spark.range(1).selectExpr("id nin", "id a"), key="nin", part="a")
    (spark.range(4).selectExpr("cast(id as string) nin", "id % 2 a").write.format("text")
     .partitionBy("a").saveAsTable(text))
    with pytest.raises(ValueError):
        E.erase_records(spark, text, spark.range(1).selectExpr("id nin", "id a"), key="nin")


def test_read_only_forms_agree(spark):
    main = spark.createDataFrame(CITIZENS + [(None, "Nobody", "1960")], SCHEMA)
    r = reqs(spark, [(30234324, "x", "1950"), (1, "y", "1960"), (None, "z", "1940")])
    left = E.erase_view(main, r, "nin", "dob")
    found = E.locate_records(main, r, "nin", "dob")
    assert left.count() + found.count() == main.count()
    assert [x.name for x in found.collect()] == ["Andy"]


def test_not_in_three_valued(spark):
    main = spark.createDataFrame(CITIZENS + [(None, "Nobody", "1960")], SCHEMA)
    r = reqs(spark, [(30234324, "Andy", "1960")])
    assert E.not_in(main, r, "nin").count() == 11          # null key row dropped
    r2 = reqs(spark, [(30234324, "Andy", "1960"), (None, "n", "1950")])
    assert E.not_in(main, r2, "nin").count() == 0
    assert E.not_in(main, reqs(spark, []), "nin").count() == len(CITIZENS) + 1   # null key too
    main.createOrReplaceTempView("m_not_in")
    r2.createOrReplaceTempView("r_not_in")
    assert spark.sql("SELECT * FROM m_not_in WHERE nin NOT IN (SELECT nin FROM r_not_in)").count() == 0


@pytest.mark.parametrize("swap,bounds", [
    ("relocate", {"BATCH_PARTITIONS": 1}), ("files", {"MAX_AFFECTED_FILES": 0}),
    ("copy", {"BATCH_PARTITIONS": 2, "MAX_PARTITION_LITERALS": 1})])
def test_bounds_change_neither_result_nor_layout(spark, monkeypatch, swap, bounds):
    """Tiny bounds mean more batches, not another swap."""
    for name, value in bounds.items():
        monkeypatch.setattr(E, name, value)
    t = make_table(spark)
    r = reqs(spark, [ANDY, PETER, ROSE, (32234328, "Terry", "1945")])
    rep = E.erase_records(spark, t, r, key="nin", swap=swap)
    assert rep.emptied == ["1945"] and rep.erased_rows == 4 and rep.touched_rows == 6
    assert spark.table(t).count() == 8
    hidden = "/_erase_" in spark.sql(
        f"DESCRIBE FORMATTED {t} PARTITION (dob='1960')").where("col_name = 'Location'").first()[1]
    assert hidden == (swap == "relocate")


def test_files_after_a_shuffled_erase(spark):
    rows = [(i, f"n{i}", str(1900 + i % 30)) for i in range(600)]
    t = make_table(spark, rows)
    r = spark.createDataFrame([(i, str(1900 + i % 30)) for i in range(0, 600, 7)],
                              "nin bigint, dob string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        E.erase_records(spark, t, r, key="nin", swap="copy", broadcast_rows=0, key_literals=0)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    files = {x[0] for x in spark.table(t).select("_metadata.file_path").distinct().collect()}
    assert len(files) == 30


def test_repeated_relocations_stay_consistent(spark):
    t = make_table(spark)
    for nin, dob in [(30234324, "1960"), (30231324, "1960"), (30234323, "1950")]:
        E.erase_records(spark, t, reqs(spark, [(nin, "x", dob)]), key="nin")
    assert spark.table(t).count() == 9
    assert "dob=1960" not in [x.partition_name for x in list_partitions(spark, t).collect()]
    # copy mode after relocations writes into the relocated folders
    E.erase_records(spark, t, reqs(spark, [(30238323, "Jessy", "1950")]), key="nin", swap="copy")
    assert spark.table(t).count() == 8


def test_read_only_forms_shuffle_path(spark):
    main = spark.createDataFrame(CITIZENS + [(None, "Nobody", "1960")] +
                                 [(30234324, "Andy", "1960")] * 20, SCHEMA)
    r = reqs(spark, [(30234324, "x", "1950"), (1, "y", "1960"), (None, "z", "1940")])
    a = E.erase_view(main, r, "nin", "dob", broadcast_rows=0, hot_rows=3, key_literals=0)
    b = E.erase_view(main, r, "nin", "dob")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0 and a.count() == 12
    found = E.locate_records(main, r, "nin", "dob", broadcast_rows=0, hot_rows=3,
                              key_literals=0)
    assert found.count() == 21


@pytest.mark.parametrize("key_literals", [0, 1000])
def test_key_paths_agree(spark, key_literals):
    """Literal IN filter and broadcast join give the same erase."""
    t = make_table(spark, CITIZENS + [(None, "Nobody", "1960")])
    r = reqs(spark, [(30234324, "Andy", "1960"), (None, "n", "1950"), (30238323, "J", "1950")])
    rep = E.erase_records(spark, t, r, key="nin", key_literals=key_literals)
    assert rep.erased_rows == 2 and spark.table(t).count() == 11


@pytest.mark.parametrize("external", [False, True])
@pytest.mark.parametrize("swap", ["relocate", "files"])
def test_erased_rows_leave_storage(spark, external, swap):
    """After relocations and an emptied partition, no file under the table
    location still holds an erased record."""
    t = make_table(spark, external=external)
    E.erase_records(spark, t, reqs(spark, [(30234324, "Andy", "1960")]), key="nin", swap=swap)
    E.erase_records(spark, t, reqs(spark, [(30231324, "Peter", "1960"),
                                           (30234323, "Peter", "1950")]), key="nin", swap=swap)
    import os

    import pyarrow.parquet as pq
    loc = spark.sql(f"DESCRIBE FORMATTED {t}").where("col_name = 'Location'").first()[1]
    root = loc.split(":", 1)[1] if loc.startswith("file:") else loc
    left = []
    for folder, _, files in os.walk(root):          # hidden folders included
        for f in files:
            if f.endswith(".parquet"):
                left += pq.read_table(os.path.join(folder, f), columns=["nin"])["nin"].to_pylist()
    assert not set(left) & {30234324, 30231324, 30234323}
    assert len(left) == 9 and spark.table(t).count() == 9


def test_files_mode_rewrites_only_affected_files(spark):
    """Partition 1940 has several files; only the one holding the key changes."""
    rows = [(i, f"n{i}", "1940") for i in range(40)]
    db_t = make_table(spark, rows)
    loc = spark.sql(f"DESCRIBE FORMATTED {db_t}").where("col_name = 'Location'").first()[1]

    def names():
        fs, p = fsutil._fs(spark, f"{loc}/dob=1940")
        return {s.getPath().getName() for s in fs.listStatus(p)
                if s.getPath().getName().endswith(".parquet")}

    before = names()
    rep = E.erase_records(spark, db_t, reqs(spark, [(7, "n7", "1940")]), key="nin", swap="files")
    after = names()
    assert rep.erased_rows == 1 and rep.touched_rows == 40 and spark.table(db_t).count() == 39
    assert len(before) > 1
    assert len(before - after) == 1 and len(after - before) <= 1


@pytest.mark.parametrize("swap", ["relocate", "copy", "files"])
def test_int_partition_column(spark, swap):
    db = scratch_database(spark)
    t = f"{db}.{unique_name('ints')}"
    rows = [(n, name, int(dob)) for n, name, dob in CITIZENS]
    (spark.createDataFrame(rows, "nin bigint, name string, dob int").write
     .partitionBy("dob").saveAsTable(t))
    r = spark.createDataFrame([(30234324, 1960), (30234328, 1945), (32234328, 1945)],
                              "nin bigint, dob int")
    rep = E.erase_records(spark, t, r, key="nin", swap=swap)
    assert rep.emptied == ["1945"] and spark.table(t).count() == 9
    assert dict(spark.table(t).dtypes)["dob"] == "int"


@pytest.mark.parametrize("swap", ["relocate", "copy", "files"])
def test_partition_values_with_spaces_and_symbols(spark, swap):
    rows = [(1, "a", "4-NOT SPECIFIED"), (2, "b", "4-NOT SPECIFIED"), (3, "c", "x/y=z%"),
            (4, "d", "x/y=z%"), (5, "e", "plain")]
    t = make_table(spark, rows)
    r = reqs(spark, [(1, "a", "4-NOT SPECIFIED"), (3, "c", "x/y=z%"), (4, "d", "x/y=z%")])
    rep = E.erase_records(spark, t, r, key="nin", swap=swap)
    assert rep.erased_rows == 3 and rep.emptied == ["x/y=z%"]
    assert sorted(x.nin for x in spark.table(t).collect()) == [2, 5]


def test_run_dying_before_marker_leaves_no_staging(spark, monkeypatch):
    """A run that fails while staging leaves the table whole; the next run
    removes the half-written staging folder inside the table."""
    t = make_table(spark)
    r = reqs(spark, [(30234324, "Andy", "1960")])

    def boom(*a, **k):
        raise RuntimeError("executor lost for good")

    real = E._check_staging
    monkeypatch.setattr(E, "_check_staging", boom)
    with pytest.raises(RuntimeError):
        E.erase_records(spark, t, r, key="nin")
    loc = spark.sql(f"DESCRIBE FORMATTED {t}").where("col_name = 'Location'").first()[1]
    fs, p = fsutil._fs(spark, loc)
    assert any(s.getPath().getName().startswith("_erase_") for s in fs.listStatus(p))
    assert spark.table(t).count() == 12
    monkeypatch.setattr(E, "_check_staging", real)
    rep = E.erase_records(spark, t, r, key="nin")
    assert rep.erased_rows == 1 and spark.table(t).count() == 11
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    assert sum(n.startswith("_erase_") for n in names) == 1     # only the live relocation


def test_not_in_several_columns_is_three_valued(spark):
    """All rows over small domains with nulls, against SQL and the definition."""
    values = [None, 1, 2]
    main = [(i, a, b, c) for i, (a, b, c) in enumerate(
        (a, b, c) for a in values for b in values for c in values)]
    m = spark.createDataFrame(main * 2, "id int, a int, b int, c int")
    lists = [[], [(1, 2, None)], [(1, None, None), (2, 2, 2)], [(None, None, 1)], [(None, None, None)],
             [(1, 1, 1), (None, 2, 1), (2, None, None)], [(9, 9, 9)]]
    for rows in lists:
        r = spark.createDataFrame(rows, "x int, y int, z int")

        def may_equal(row, other):
            return all(p is None or q is None or p == q for p, q in zip(row[1:], other, strict=True))
        want = sorted([x for x in main if not any(may_equal(x, y) for y in rows)] * 2, key=repr)
        got = E.not_in(m, r, ["a", "b", "c"], ["x", "y", "z"])
        assert sorted(map(tuple, got.collect()), key=repr) == want, rows
        assert "BroadcastNestedLoopJoin" not in got._jdf.queryExecution().toString()
        m.createOrReplaceTempView("m_several")
        r.createOrReplaceTempView("r_several")
        sql = spark.sql("SELECT * FROM m_several WHERE (a, b, c) NOT IN (SELECT x, y, z FROM r_several)")
        assert sorted(map(tuple, sql.collect()), key=repr) == want
    with pytest.raises(ValueError):
        E.not_in(m, m, ["a", "b"], ["a"])
