"""DuckDB SQL for each registered query (the independent oracle).

Views ``region nation customer supplier part orders lineitem events ...`` are
the given parquet tables.  Column names equal those of the Spark queries.
"""

from __future__ import annotations

from tessera.config import GeneratorConfig

# Written out here, not imported from the code that is checked.
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
LETTERS_PER_CHUNK = 6
HEX_PER_CHUNK = 13


def letter_chunk_count(length: int) -> int:
    return -(-length // LETTERS_PER_CHUNK)


def _u32(expr: str) -> str:
    return f"('0x' || substr({expr}, 1, 8))::bigint"


def _md5(seed: int, name: str, id_sql: str, block: int | None = None) -> str:
    tail = f", ':{block}'" if block is not None else ""
    return f"md5(concat('{seed}:{name}:', {id_sql}{tail}))"


def _uuid(seed: int, name: str, id_sql: str) -> str:
    h = _md5(seed, name, id_sql)
    return (f"concat(substr({h},1,8),'-',substr({h},9,4),'-4',substr({h},14,3),'-',"
            f"substr('89ab', (1 + ('0x' || substr({h},17,1))::int % 4)::int, 1),"
            f"substr({h},18,3),'-',substr({h},21,12))")


def _letters(seed: int, name: str, id_sql: str, length: int) -> str:
    n = len(ALPHABET)
    chunks = letter_chunk_count(length)
    blocks = -(-chunks * HEX_PER_CHUNK // 32)
    digest = "concat(" + ", ".join(_md5(seed, name, id_sql, b) for b in range(blocks)) + ")"
    values = [f"('0x' || substr({digest}, {1 + HEX_PER_CHUNK * c}, {HEX_PER_CHUNK}))::bigint"
              for c in range(chunks)]
    picks = []
    for i in range(length):
        v, j = values[i // LETTERS_PER_CHUNK], i % LETTERS_PER_CHUNK
        picks.append(f"substr('{ALPHABET}', (1 + ({v} // {n ** j}) % {n})::int, 1)")
    return "concat(" + ", ".join(picks) + ")"


def generate_records_sql(id_sql: str, from_sql: str, cfg: GeneratorConfig = GeneratorConfig()) -> str:
    s = cfg.seed
    days = (cfg.end - cfg.start).days
    cols = [
        f"{id_sql} AS id",
        f"{_uuid(s, 'NIN', id_sql)} AS NIN",
        f"{_uuid(s, 'NAME', id_sql)} AS NAME",
        f"{_u32(_md5(s, 'BENEFITS', id_sql))} / 4294967296.0::double AS BENEFITS",
        f"{_letters(s, 'ADDRESS', id_sql, cfg.address_len)} AS ADDRESS",
        f"{_u32(_md5(s, 'BALANCE', id_sql))} / 4294967296.0::double AS BALANCE",
        f"{_letters(s, 'ACC_NAME', id_sql, cfg.accname_len)} AS ACC_NAME",
        f"({_u32(_md5(s, 'CODE', id_sql))} % {cfg.code_range})::int AS CODE",
        f"({_u32(_md5(s, 'PARTITIONER', id_sql))} % {cfg.partitions})::int::varchar AS PARTITIONER",
        f"(DATE '{cfg.start.isoformat()}' + ({_u32(_md5(s, 'DATE', id_sql))} % {days})::int)::date AS DATE",
    ]
    return "SELECT " + ", ".join(cols) + f" FROM {from_sql}"


ERASE_REQUESTS = (
    "req AS (SELECT o.o_orderkey AS k, CASE WHEN o.o_orderstatus = 'F' THEN '1-URGENT' "
    "ELSE '5-LOW' END AS p FROM orders o WHERE o.o_custkey IN "
    "(SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'))")

ERASE_LEFT = (
    f"WITH {ERASE_REQUESTS} SELECT * FROM orders "
    "WHERE NOT (o_orderpriority IN (SELECT p FROM req) AND o_orderkey IN (SELECT k FROM req))")

SECOND_REQUESTS = (
    "req2 AS (SELECT o_orderkey AS k FROM orders WHERE o_custkey IN "
    "(SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY'))")

# after both request lists; rows appended in between are not in either
ERASE_BOTH = (
    f"WITH {ERASE_REQUESTS}, {SECOND_REQUESTS} SELECT * FROM orders "
    "WHERE NOT (o_orderpriority IN (SELECT p FROM req) AND o_orderkey IN (SELECT k FROM req)) "
    "AND NOT (o_orderpriority = '3-MEDIUM' AND o_orderkey IN (SELECT k FROM req2))")
ERASE_BOTH_APPENDED = (
    ERASE_BOTH + " UNION ALL SELECT * REPLACE (-o_orderkey AS o_orderkey) FROM orders "
    "WHERE o_orderstatus = 'F'")


RECORD_COLS = ["NIN", "NAME", "BENEFITS", "ADDRESS", "BALANCE", "ACC_NAME", "CODE",
               "PARTITIONER", "DATE"]


def _flow_inputs() -> str:
    """DuckDB CTEs: ``rec`` (records per order key), ``base`` (BENEFITS + 1)
    and ``other`` (the 10 % md5 split of ``rec`` on NIN)."""
    return (f"rec AS ({generate_records_sql('o_orderkey', 'orders')}), "
            "base AS (SELECT NIN, NAME, BENEFITS + 1 AS BENEFITS, ADDRESS, BALANCE, ACC_NAME, "
            "CODE, PARTITIONER, DATE FROM rec), "
            "other AS (SELECT NIN, NAME, BENEFITS, ADDRESS, BALANCE, ACC_NAME, CODE, "
            "PARTITIONER, DATE FROM rec WHERE ('0x' || substr(md5(concat('42:', NIN)), 1, 8))"
            "::bigint < 429496730)")


# The 17 column names of joined records.
JOINED = ["newCol1", "newCol2", "newCol3", "newCol4", "newCol5", "newCol6", "newCol7", "newCol8",
          "newCol9", "newCol10", "newCol11", "newCol12", "newCol13", "newCol14", "newCol15",
          "newcol16", "newcol17"]


def _flow_join_sql(key: str) -> str:
    left = [f"b.{key}"] + [f"b.{c}" for c in RECORD_COLS if c != key]
    right = [f"o.{c}" for c in RECORD_COLS if c != key]
    cols = ", ".join(f'{e} AS "{n}"' for e, n in zip(left + right, JOINED, strict=True))
    return f"WITH {_flow_inputs()} SELECT {cols} FROM base b JOIN other o ON b.{key} = o.{key}"


def _flow_cube_sql(key: str) -> str:
    return (f"WITH {_flow_inputs()} SELECT {key}, ADDRESS, "
            f"CAST(grouping({key}) * 2 + grouping(ADDRESS) AS bigint) AS gid, "
            'round(avg(BENEFITS), 6) AS "avg(BENEFITS)", max(BALANCE) AS "max(BALANCE)" '
            f"FROM base GROUP BY CUBE ({key}, ADDRESS)")


def _summary_sql(label: str, group: str) -> str:
    span = "(max(epoch_us(ts) + round(value * 1000)::bigint) - min(epoch_us(ts)))"
    return (f"SELECT {label} AS label, count(*) AS samples, round(sum(value) / count(*), 6) AS avg_ms, "
            "min(value) AS min_ms, max(value) AS max_ms, round(sqrt(var_pop(value)), 6) AS std_ms, "
            "round(100.0::double * count(*) FILTER (event_type = 'error') / count(*), 6) AS error_pct, "
            f"round(count(*) / (nullif({span}, 0) / 1e6::double), 6) AS throughput_per_sec "
            f"FROM events {group}")


ORACLE_SQL: dict[str, str] = {
    "scan_parquet": "SELECT * FROM orders",
    "scan_table": "SELECT * FROM orders",
    "write_table": "SELECT * FROM orders",
    "scan_csv": "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
    "write_file": "SELECT * FROM customer",
    "scan_json": "SELECT * FROM part",
    "write_clustered": "SELECT * FROM lineitem",
    "write_partitioned": "SELECT * FROM orders",
    "write_table_partitioned": "SELECT * FROM orders",
    "append_table": "SELECT * FROM lineitem",
    "list_partitions":
        "SELECT DISTINCT concat('l_returnflag=', l_returnflag) AS partition_name FROM lineitem",
    "list_partition_dirs":
        "SELECT DISTINCT concat('l_returnflag=', l_returnflag) AS partition_name FROM lineitem",
    "scan_partitions":
        "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN "
        "(SELECT o_orderpriority FROM orders WHERE o_totalprice = "
        "(SELECT max(o_totalprice) FROM orders))",
    "add_one": "SELECT * REPLACE (l_quantity + 1 AS l_quantity) FROM lineitem",
    "read_workload": "SELECT * REPLACE (l_quantity + 1 AS l_quantity) FROM lineitem",
    "cast_date":
        "SELECT o_orderkey, CAST(CAST(o_orderdate AS date) AS timestamp) AS o_ts FROM orders",
    "rename_columns":
        "SELECT c_custkey AS new_col1, c_name AS new_col2, c_nationkey AS new_col3, "
        "c_acctbal AS new_col4, c_mktsegment AS new_col5 FROM customer",
    "filter_partition": "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderpriority = '2-HIGH'",
    "not_in":
        "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN "
        "(SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')",
    "not_in_null":
        "SELECT count(*) AS n FROM orders WHERE o_custkey NOT IN "
        "(SELECT CASE WHEN c_custkey > 0 THEN c_custkey END FROM customer)",
    "not_in_two":
        "WITH m AS (SELECT o_orderkey, CASE WHEN o_custkey % 11 <> 0 THEN o_custkey END AS o_custkey, "
        "CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey % 3 END AS o_shippriority FROM orders), "
        "r AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 13 <> 0 THEN c_custkey % 3 END AS p "
        "FROM customer WHERE c_mktsegment = 'BUILDING' AND c_custkey % 50 <> 0) "
        "SELECT * FROM m WHERE NOT EXISTS (SELECT 1 FROM r WHERE "
        "(o_custkey = k OR o_custkey IS NULL OR k IS NULL) "
        "AND (o_shippriority = p OR o_shippriority IS NULL OR p IS NULL))",
    "join_inner":
        "SELECT o.*, c.* FROM orders o "
        "JOIN customer c ON o.o_custkey = c.c_custkey",
    "join_inner_using":
        "SELECT * FROM orders JOIN "
        "(SELECT l_orderkey AS o_orderkey, * EXCLUDE (l_orderkey) FROM lineitem) AS li "
        "USING (o_orderkey)",
    "locate_indexed":
        f"WITH {ERASE_REQUESTS} SELECT o_orderkey, o_orderpriority FROM orders WHERE "
        "o_orderpriority IN (SELECT p FROM req) AND o_orderkey IN (SELECT k FROM req)",
    "locate_records":
        f"WITH {ERASE_REQUESTS} SELECT o_orderkey, o_orderpriority FROM orders WHERE "
        "o_orderpriority IN (SELECT p FROM req) AND o_orderkey IN (SELECT k FROM req)",
    "erase_view": ERASE_LEFT,
    "erase_records": ERASE_LEFT,
    "erase_path": ERASE_LEFT,
    "erase_path_files": ERASE_LEFT,
    "erase_files": ERASE_LEFT,
    **{f"erase_resume_{s}": ERASE_BOTH for s in ("relocate", "copy", "files")},
    **{f"erase_after_append_{s}": ERASE_BOTH_APPENDED for s in ("relocate", "copy", "files")},
    **{f"erase_{f}_table_{s}": ERASE_LEFT
       for f in ("csv", "json") for s in ("relocate", "copy", "files")},
    "not_in_empty":
        "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN o_custkey END AS o_custkey "
        "FROM orders",
    "split_random":
        "SELECT o_orderkey, o_orderpriority, CAST(1 AS bigint) AS parts, count(*) AS copies "
        "FROM orders GROUP BY ALL",
    "sql_file":
        "SELECT o_orderpriority, 'a;b' AS mark, count(*) AS n FROM orders "
        "GROUP BY o_orderpriority",
    "io_round_robin":
        "SELECT CAST(10 AS bigint) AS files, CAST(count(*) AS bigint) AS rows FROM lineitem",
    "scan_partition_dirs":
        "SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem "
        "WHERE l_returnflag IN ('A', 'R')",
    "erase_empties_partition":
        "SELECT * FROM orders WHERE o_orderpriority <> '2-HIGH'",
    "group_sum":
        "SELECT l_returnflag, CAST(sum(CAST(l_quantity AS decimal(18,2))) AS double) AS sum_qty "
        "FROM lineitem GROUP BY l_returnflag",
    "cube_avg_max":
        "SELECT l_returnflag, l_linestatus, "
        "CAST(grouping(l_returnflag) * 2 + grouping(l_linestatus) AS bigint) AS gid, "
        "round(avg(l_quantity), 6) AS avg_qty, max(l_tax) AS max_tax "
        "FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)",
    "count_rows": "SELECT count(*) AS n FROM lineitem",
    "take_from_partition":
        "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority = '5-LOW' "
        "ORDER BY o_orderkey LIMIT 2",
    "split_by_hash":
        "SELECT o_orderkey, CASE WHEN ('0x' || substr(md5(concat('42:', o_orderkey)), 1, 8))"
        "::bigint < 429496730 THEN 'test' ELSE 'train' END AS part FROM orders",
    "repartition_rows": "SELECT * FROM events",
    "replicate_rows":
        "SELECT c_custkey, c_name, g.copy::int AS copy FROM customer, "
        "generate_series(1, 3) AS g(copy)",
    "generate_records": generate_records_sql("o_orderkey", "orders"),
    "generate_table":
        "SELECT * EXCLUDE (id) REPLACE (CAST(DATE AS timestamp) AS DATE) FROM ("
        + generate_records_sql("o_orderkey", "orders") + ")",
    "split_table":
        "SELECT * FROM orders WHERE "
        "('0x' || substr(md5(concat('42:', o_orderkey)), 1, 8))::bigint < 429496730",
    "stage_flow":
        "SELECT o_orderpriority, CAST(sum(CAST(o_totalprice + 1 AS decimal(18,2))) AS double) "
        "AS sum_price FROM orders GROUP BY o_orderpriority",
    "erase_generated":
        f"WITH rec AS ({generate_records_sql('o_orderkey', 'orders')}), "
        "req AS (SELECT NIN, PARTITIONER FROM rec WHERE PARTITIONER = '11' "
        "ORDER BY NIN LIMIT 2) "
        "SELECT * EXCLUDE (id) REPLACE (CAST(DATE AS timestamp) AS DATE) FROM rec WHERE NOT (PARTITIONER IN "
        "(SELECT PARTITIONER FROM req) AND NIN IN (SELECT NIN FROM req))",
    "flow_group_nin":
        f'WITH {_flow_inputs()} SELECT NIN, sum(BENEFITS) AS "sum(BENEFITS)" FROM base '
        "GROUP BY NIN",
    "flow_join_address": _flow_join_sql("ADDRESS"),
    "flow_join_write": _flow_join_sql("NIN"),
    "flow_cube_partitioner": _flow_cube_sql("PARTITIONER"),
    "flow_cube_nin": _flow_cube_sql("NIN"),
    "flow_chain": _flow_cube_sql("NIN"),
    "sql_text":
        "SELECT n.n_name, count(*) AS n FROM customer c JOIN nation n "
        "ON c.c_nationkey = n.n_nationkey GROUP BY n.n_name HAVING count(*) > 1",
    "ingest": "SELECT s_suppkey, s_name, s_nationkey, s_acctbal + 1 AS s_acctbal FROM supplier",
    "run_summary":
        _summary_sql("event_type", "GROUP BY event_type") + " UNION ALL "
        + _summary_sql("'TOTAL'", ""),
    "io_files":
        "SELECT CAST(l_orderkey % 10 AS int) AS file_no, count(*) AS row_count "
        "FROM lineitem GROUP BY CAST(l_orderkey % 10 AS int)",
    "stage_metrics":
        "SELECT l_returnflag AS application, CAST(l_linenumber AS bigint) AS stage_id, "
        "count(*) AS tasks, CAST(sum(l_suppkey) AS bigint) AS run_ms, "
        "CAST(sum(3 * l_partkey + l_suppkey) AS bigint) AS shuffle_read_bytes, "
        "CAST(sum(l_partkey) AS bigint) AS shuffle_write_bytes, "
        "CAST(sum(l_linenumber + trunc(l_quantity)) AS bigint) AS spill_bytes, "
        "CAST(sum(3 * l_partkey) AS bigint) AS remote_read_bytes, "
        "CAST(max(l_orderkey) AS bigint) AS peak_memory_bytes, "
        "CAST(sum(trunc(l_quantity)) AS bigint) AS disk_spill_bytes, "
        "CAST(sum(2 * l_orderkey) AS bigint) AS input_bytes, "
        "CAST(sum(7 * trunc(l_quantity)) AS bigint) AS output_bytes, "
        "round(sum(2 * l_orderkey + 3 * l_partkey + l_suppkey) * 1000.0::double "
        "/ sum(l_suppkey), 3) AS bytes_per_sec FROM lineitem "
        "GROUP BY l_returnflag, l_linenumber",
}
