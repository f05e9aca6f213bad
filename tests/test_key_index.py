"""Key index and clustered writes: only candidate files, few row groups."""

import os
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tessera import operators as O
from tessera import sinks as K
from tessera.operators import key_index as X
from tessera.session import scratch_database, scratch_path, unique_name


def make(spark, n=40_000, parts=3, files=8, text=False, step=1):
    rows = spark.range(n).select(
        (F.col("id") * 7919 % n * step).alias("nin") if not text
        else F.concat(F.lit("k"), F.col("id") * 7919 % n).alias("nin"),
        F.lpad(F.col("id").cast("string"), 40, "x").alias("name"),
        (F.col("id") % parts).cast("string").alias("dob"))
    name = f"{scratch_database(spark)}.{unique_name('indexed')}"
    rows.repartition(files).write.partitionBy("dob").saveAsTable(name)
    return name


def requests(spark, keys, parts=("0", "1", "2")):
    return spark.createDataFrame([(k, p) for k in keys for p in parts],
                                 f"nin {'string' if isinstance(keys[0], str) else 'bigint'}, dob string")


def same(spark, name, req, index):
    got = O.locate_indexed(spark, name, req, "nin", index)
    want = O.locate_records(spark.table(name), req, "nin", "dob")
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    return got


@pytest.mark.parametrize("text", [False, True])
def test_lookup_equals_the_scan(spark, text, monkeypatch):
    monkeypatch.setattr(X, "BLOCK_BYTES", 2 * 1024)          # several blocks a file
    name, index = make(spark, text=text), scratch_path(spark, "index")
    O.build_key_index(spark, name, "nin", index)
    assert spark.read.parquet(index).agg(F.max("blocks")).first()[0] >= 4
    key = (lambda k: f"k{k}") if text else (lambda k: k)
    for keys in ([5], [1, 2, 39_999, 50_000], [-1], list(range(0, 40_000, 97))):
        same(spark, name, requests(spark, [key(k) for k in keys]), index)
    same(spark, name, requests(spark, [key(5)], ["1", "9"]), index)
    assert O.locate_indexed(spark, name, requests(spark, [key(5)]).limit(0), "nin", index).count() == 0
    same(spark, name, spark.createDataFrame([(key(8), "0"), (None, "1"), (key(9), None)],
                                            requests(spark, [key(1)]).schema), index)


def test_only_candidates_are_opened_and_false_positives_are_few(spark):
    name, index = make(spark, files=30, step=2), scratch_path(spark, "index")
    O.build_key_index(spark, name, "nin", index)
    facts = spark.table(name).select(
        X.path_key(F.col("_metadata.file_path"), uri=True).alias("file"),
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"),
        F.unix_millis("_metadata.file_modification_time").alias("time"), "nin")
    files, built = facts.select("path", "file", "size", "time").distinct().cache(), spark.read.parquet(index)
    total = files.count()
    assert total == 90

    def candidates(keys):
        wanted = spark.createDataFrame([(k,) for k in keys], "nin bigint")
        return {r.file for r in X.candidate_files(built, files, wanted, "nin").collect()}
    true = {r.file for r in facts.where(F.col("nin").isin([100, 102, 104])).select("file").distinct().collect()}
    assert true <= candidates([100, 102, 104]) and len(candidates([100, 102, 104])) <= len(true) + 2
    # odd keys lie inside every file's range, but in none
    wrong = sum(len(candidates([k])) for k in range(20_001, 20_011, 2))
    assert wrong / (5 * total) < 0.03
    got = O.locate_indexed(spark, name, requests(spark, [100]), "nin", index)
    assert len(names(got)) == 1 < total


def names(df):
    """The file names to which a frame's scan is pruned."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return set(re.findall(r"part-[0-9a-f.-]+c000[.a-z]*parquet", plan))


def test_files_after_the_index_are_searched_and_a_refresh_reads_only_them(spark):
    name, index = make(spark), scratch_path(spark, "index")
    O.build_key_index(spark, name, "nin", index)
    before = spark.read.parquet(index).select("file").distinct().count()
    late = spark.createDataFrame([(5, "late", "1"), (77_777, "late", "7")], "nin bigint, name string, dob string")
    late.write.insertInto(name)
    got = same(spark, name, requests(spark, [5, 77_777], ["0", "1", "7"]), index)
    assert got.where("name = 'late'").count() == 2
    assert O.refresh_key_index(spark, name, "nin", index) == 2
    assert O.refresh_key_index(spark, name, "nin", index) == 0
    assert spark.read.parquet(index).select("file").distinct().count() == before + 2
    same(spark, name, requests(spark, [5, 77_777], ["0", "1", "7"]), index)


def test_many_keys_or_files_are_searched_without_the_index(spark, monkeypatch):
    name, index = make(spark), scratch_path(spark, "index")
    O.build_key_index(spark, name, "nin", index)
    monkeypatch.setattr(X, "MAX_LOOKUP_KEYS", 3)
    same(spark, name, requests(spark, [1, 2, 3, 4]), index)
    monkeypatch.setattr(X, "MAX_FILE_LITERALS", 0)
    same(spark, name, requests(spark, [1]), index)


def test_null_keys_and_empty_tables(spark):
    name = f"{scratch_database(spark)}.{unique_name('nulls')}"
    rows = spark.createDataFrame([(None, "a", "x"), (1, "b", "x y"), (2, None, "x/y")],
                                 "nin bigint, name string, dob string")
    K.write_table(rows, name, partition_by="dob")
    index = scratch_path(spark, "index")
    O.build_key_index(spark, name, "nin", index)
    assert spark.read.parquet(index).select("file").distinct().count() == 3
    same(spark, name, requests(spark, [1, 2], ["x", "x y", "x/y"]), index)
    assert O.refresh_key_index(spark, name, "nin", index) == 0


def groups(path, key):
    """(folder, file, row group, least, most) of the key."""
    for folder, _, names in os.walk(path.replace("file:", "").replace("//", "/")):
        for f in sorted(names):
            if f.endswith(".parquet"):
                meta = pq.ParquetFile(os.path.join(folder, f)).metadata
                at = [c for c in range(meta.num_columns) if meta.schema.column(c).name == key][0]
                for g in range(meta.num_row_groups):
                    s = meta.row_group(g).column(at).statistics
                    yield folder, f, g, s.min, s.max


def test_at_most_two_row_groups_overlap_a_key(spark):
    n = 60_000
    rows = spark.range(n).select((F.col("id") * 7919 % (n // 4)).alias("nin"), F.md5(F.col("id").cast("string"))
                                 .alias("name"), (F.col("id") % 3).cast("string").alias("dob"))
    path = scratch_path(spark, "clustered")
    K.write_clustered(rows.repartition(6), "nin", path=path, partition_by="dob", files=8,
                      options={"parquet.block.size": "65536", "parquet.page.size": "8192"})
    got = spark.read.schema(rows.schema).parquet(path)
    assert got.exceptAll(rows).count() == 0 and got.count() == n
    found = list(groups(path, "nin"))
    assert len(found) > 20
    for key in range(0, n // 4, 501):
        for part in {g[0] for g in found}:
            assert sum(g[0] == part and g[3] <= key <= g[4] for g in found) <= 2


def test_a_key_with_a_third_of_the_rows_is_cut(spark):
    rows = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("nin"),
                                      F.col("id").alias("other"))
    sizes = K.cluster_by_key(rows, "nin", files=12).groupBy(F.spark_partition_id()).count().collect()
    assert max(r[1] for r in sizes) < 30_000 / 12 * 2.5
