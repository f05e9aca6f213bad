"""Line dedup against a plain scan of all windows."""

import re

import duckdb
import xxhash

from tessera.llm import line_dedup
from tessera.llm.oracle import ORACLE_SQL
from tests.llm.rows import SCHEMA, clashing, edge_frame, empty_frame, prose


def brute(rows):
    """(doc_id, text) -> (text, removed); exact repetitions hold one place."""
    def at(doc_id, text, p):
        k = xxhash.xxh64_intdigest((text or "").encode(), 42) >> 33
        return -2 ** 63 if doc_id is None else doc_id, k, p

    first, out = {}, []
    windows = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        for p in range(len(lines) - 2):
            if re.search(r"[^\x20\x09-\x0D]", "".join(lines[p:p + 3])):
                windows.append((tuple(lines[p:p + 3]), at(doc_id, text, p)))
    for window, place in windows:
        first[window] = min(first.get(window, place), place)
    for doc_id, text in rows:
        lines, gone = (text or "").split("\n"), set()
        for p in range(len(lines) - 2):
            w = tuple(lines[p:p + 3])
            if w in first and at(doc_id, text, p) > first[w]:
                gone |= {p, p + 1, p + 2}
        left = "\n".join(x for i, x in enumerate(lines) if i not in gone)
        out.append((doc_id, left if gone else text, len(lines), len(gone)))
    return sorted(out, key=repr)


def check(df):
    got = line_dedup.dedup_lines(df.select("doc_id", "text"))
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def test_edge_rows(spark):
    check(edge_frame(spark))


def test_overlapping_and_inner_repeats(spark):
    lines = [f"line {i}" for i in range(30)]
    rows = [(1, lines[0:10]), (2, lines[5:20]), (3, ["a"] * 9), (4, lines[0:3] + ["x"] + lines[8:12]),
            (5, lines[0:2]), (6, ["", "", ""] * 3), (7, ["a", "a", "a"]), (-1, lines[18:22])]
    check(spark.createDataFrame([(i, "\n".join(x), "en", "s", 0) for i, x in rows], SCHEMA))


def test_many_copies_and_long_texts(spark):
    rows = [(i, prose(i % 7, 200), "en", "s", 0) for i in range(300)]
    rows.append((1000, prose(3, 200) + "\n" + prose(99, 30_000), "en", "s", 0))
    check(spark.createDataFrame(rows, SCHEMA))


def test_other_columns_stay_and_names_do_not_clash(spark):
    df = clashing(edge_frame(spark), "k", "id", "n_lines", "pos", "gone", "h1")
    got = line_dedup.dedup_lines(df)
    assert got.columns == [*df.columns, "_n_lines", "n_removed"]
    assert got.where("k = 'clash' and gone = 'clash'").count() == df.count()


def test_empty_table(spark):
    assert line_dedup.dedup_lines(empty_frame(spark)).count() == 0


def test_shuffled_lookup_gives_the_same(spark, monkeypatch):
    from tessera.llm import common
    rows = [(i, prose(i % 5, 150), "en", "s", 0) for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA)
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(common, "HOT_ROWS", 20)
    check(df)


def test_one_id_or_none_under_several_texts(spark):
    passage = "\n".join(f"line {i}" for i in range(6))
    rows = [(i, f"{head}\n{passage}\n{tail}", "en", "s", 0) for i, head, tail in
            [(None, "a", "b"), (None, "c", "d"), (None, "a", "b"), (1, "e", "f"), (7, "g", "h"),
             (7, "i", "j"), (7, "k", "l")]]
    df = spark.createDataFrame(rows, SCHEMA)
    check(df)
    got = line_dedup.dedup_lines(df.where("doc_id is null or doc_id = 7")).groupBy("doc_id").sum("n_removed")
    assert {r[0]: r[1] for r in got.collect()} == {None: 6, 7: 18}      # one of each text is the first


def test_blank_and_worded_lines_as_the_sql_has_it(spark):
    """Windows of spaces only don't count; capitals, digits, backslash and x do."""
    blank, caps = "   \n\t \x0b\n ", "ABC\n029\n\\x"
    texts = [blank, caps, f"{blank}\n{caps}", f"{caps}\n{blank}", "x\nx\nx", "\u00a0\n\u2003\n\u00a0"]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts * 2)], SCHEMA)
    check(df)
    con = duckdb.connect()
    con.register("documents", df.toPandas())
    want = con.execute("select doc_id, text, n_lines, n_removed from (" + ORACLE_SQL["op2_line_dedup"]
                       + ")").fetchall()
    got = line_dedup.dedup_lines(df).select("doc_id", "text", "n_lines", "n_removed").collect()
    assert sorted(map(tuple, got)) == sorted(want)
    assert {r.doc_id: r.n_removed for r in got}[7] == 3 and {r.doc_id: r.n_removed for r in got}[6] == 0


def test_names_with_dots(spark):
    df = edge_frame(spark).withColumnsRenamed({"doc_id": "a.id", "text": "the.text", "lang": "x.y"})
    got = line_dedup.dedup_lines(df, "a.id", "the.text")
    assert got.columns[:5] == df.columns and got.count() == df.count()
