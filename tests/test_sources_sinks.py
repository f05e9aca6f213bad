"""Round trips through every source and sink; partition listing and pruning."""

import pytest
from pyspark.sql import functions as F

from tessera import sinks as K
from tessera import sources as S
from tessera.session import scratch_database, scratch_path, unique_name
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def orders(spark):
    return S.read_parquet(spark, f"{SF_SMALL}/orders.parquet")


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet"])
def test_file_round_trip_with_schema(spark, orders, fmt):
    df = orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    path = scratch_path(spark, fmt)
    K.write_file(df, path, fmt)
    assert same(S.read_files(spark, fmt, path, df.schema), df)


def test_csv_header_and_inference(spark, orders):
    df = orders.select("o_orderkey", "o_orderpriority")
    path = scratch_path(spark, "csv")
    K.write_file(df.repartition(4), path, "csv")
    back = S.read_csv(spark, path)
    assert back.columns == ["o_orderkey", "o_orderpriority"]
    assert back.count() == df.count()   # one header per part file, none counted as rows


def test_unknown_format_is_an_error(spark, orders):
    with pytest.raises(ValueError):
        K.write_file(orders, scratch_path(spark, "x"), "avro")
    with pytest.raises(ValueError):
        S.read_files(spark, "orc2", "/nowhere")
    with pytest.raises(ValueError):
        K.write(orders)


def test_partitioned_write_bounds_files(spark, orders):
    path = scratch_path(spark, "part")
    K.write_file(orders, path, "parquet", partition_by="o_orderpriority", files_per_partition=2)
    back = S.read_parquet(spark, path, orders.schema)
    assert same(back, orders)
    files = back.select("o_orderpriority", F.col("_metadata.file_name").alias("f")).distinct() \
        .groupBy("o_orderpriority").count().collect()
    assert len(files) == 5 and max(r["count"] for r in files) <= 2


def test_table_partitions_listing_and_pruning(spark, orders):
    name = f"{scratch_database(spark)}.{unique_name('o')}"
    K.write(orders, table=name, partition_by="o_orderpriority")
    parts = sorted(r.partition_name for r in S.list_partitions(spark, name).collect())
    assert parts[0] == "o_orderpriority=1-URGENT" and len(parts) == 5
    assert S.partition_columns(spark, name) == ["o_orderpriority"]
    lit = S.read_partitions(spark, name, "o_orderpriority", ["2-HIGH"])
    req = spark.createDataFrame([("2-HIGH",), (None,)], "o_orderpriority string")
    semi = S.read_partitions(spark, name, "o_orderpriority", req)
    semi_forced = S.read_partitions(spark, name, "o_orderpriority", req, bound=0)
    expected = orders.where("o_orderpriority = '2-HIGH'").select(*lit.columns)
    assert same(lit, expected) and same(semi, expected) and same(semi_forced, expected)
    from tests.test_plans import plan_text
    plan = plan_text(lit)
    assert "PartitionFilters: [isnotnull(o_orderpriority" in plan and "2-HIGH" in plan


def test_append_and_insert_overwrite(spark, orders):
    name = f"{scratch_database(spark)}.{unique_name('o')}"
    a = orders.where("o_orderkey % 2 = 0")
    b = orders.where("o_orderkey % 2 = 1")
    K.write_table(a, name, partition_by="o_orderpriority")
    K.append_table(b, name)
    assert same(spark.table(name), orders.select(*spark.table(name).columns))
    # replace one partition only
    new = orders.where("o_orderpriority = '3-MEDIUM'").limit(3)
    K.insert_overwrite_partitions(new, name)
    spark.catalog.refreshTable(name)
    t = spark.table(name)
    assert t.where("o_orderpriority = '3-MEDIUM'").count() == 3
    assert t.where("o_orderpriority <> '3-MEDIUM'").count() == \
        orders.where("o_orderpriority <> '3-MEDIUM'").count()


def test_write_db_casts_date(spark):
    df = spark.sql("SELECT 1 AS id, DATE'2018-01-02' AS DATE")
    name = f"{scratch_database(spark)}.{unique_name('d')}"
    K.write(df, table=name, date_column="DATE")
    assert dict(spark.table(name).dtypes)["DATE"] == "timestamp"


def test_jdbc_options_checked(spark):
    with pytest.raises(ValueError):
        S.read_jdbc(spark, "jdbc:none:x", "t", partition_column="id")


def test_partition_dirs_pruned_and_typed(spark, orders):
    path = scratch_path(spark, "pdirs")
    K.write_file(orders, path, "parquet", partition_by="o_orderpriority")
    df = S.read_partition_dirs(spark, path, "o_orderpriority", ["5-LOW"], orders.schema)
    assert same(df, orders.where("o_orderpriority = '5-LOW'"))
    from tests.test_plans import plan_text
    text = plan_text(df)
    assert "PartitionFilters: [isnotnull(o_orderpriority" in text and "5-LOW" in text


def test_list_partition_dirs(spark, orders):
    path = scratch_path(spark, "ldirs")
    K.write_file(orders, path, "parquet", partition_by="o_orderpriority")
    names = [r.partition_name for r in S.list_partition_dirs(spark, path, "o_orderpriority").collect()]
    assert names == sorted(f"o_orderpriority={p}" for p in
                           ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"])


def test_describe_table_and_partition(spark, orders):
    name = f"{scratch_database(spark)}.{unique_name('d')}"
    K.write_table(orders, name, partition_by="o_orderpriority")
    t = S.describe(spark, name)
    assert t["partition_columns"] == ["o_orderpriority"] and t["type"] == "MANAGED"
    p = S.describe(spark, name, "PARTITION (o_orderpriority = '2-HIGH')")
    assert p["location"].endswith("/o_orderpriority=2-HIGH")
    assert p["location"].startswith(t["location"])


def test_jdbc_paths_reach_the_driver_manager(spark):
    """Without a database the JDBC read and write get as far as asking for a
    driver for the URL (no server or database is started by the tests)."""
    with pytest.raises(Exception) as read_err:
        S.read_jdbc(spark, "jdbc:tessera-none:db", "t", partition_column="id", lower_bound=0,
                    upper_bound=10, num_partitions=2, custom_schema="id DECIMAL(38,0)").count()
    assert "suitable driver" in str(read_err.value).lower()
    with pytest.raises(Exception) as write_err:
        K.write_jdbc(spark.range(3), "jdbc:tessera-none:db", "t", column_types="id BIGINT")
    assert "suitable driver" in str(write_err.value).lower()


def test_partitioned_writes_make_few_files(spark):
    """Not tasks x values: a task holds whole values, hot ones are split by size."""
    from tessera.sinks import write_file
    from tessera.session import scratch_path
    path = scratch_path(spark, "few_files")
    write_file(spark.range(0, 4000, 1, 16).selectExpr("id", "id % 20 AS p"), path, partition_by="p")
    back = spark.read.parquet(path)
    assert back.count() == 4000
    assert back.select("_metadata.file_path").distinct().count() == 20
