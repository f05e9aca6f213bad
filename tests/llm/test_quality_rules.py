"""Quality rules: base statistics by brute force, estimates by numpy."""

import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import quality_rules as Q
from tests.llm.rows import SCHEMA, clashing, edge_frame, empty_frame, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text or "")
    grams = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if grams[tuple(words[i:i + 8])] > 1
               for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(covered))


def check_base(df):
    got = Q.judge(df).collect()
    want = [(r.doc_id, *brute(r.text)) for r in df.collect()]
    assert sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
                   for r in got), key=repr) == sorted(want, key=repr)
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)
    return got


def test_edge_rows(spark):
    check_base(clashing(edge_frame(spark), "id", "k1", "words", "cell", "x1", "n", "fine"))


def test_repeated_windows(spark):
    eight = "a b c d e f g h"
    texts = [f"{eight} {eight}", f"{eight} x {eight} y " + prose(4, 50), "z " * 9, "z " * 8,
             f"{eight} i {eight} i q", "u\nu\nv\n\n\nu", "# * $ % & | < > " * 3]
    check_base(spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], SCHEMA))


def _corpus(spark):
    rows = [(i, prose(i + 1, 60 + i % 90), "en", "s0" if i % 3 else "s1", 0) for i in range(900)]
    for i in range(60):        # every word with symbols, or shouting
        words = prose(5000 + i, 80).split()
        mark = "%%%" if i % 2 else "!!!!!!"
        rows.append((2000 + i, " ".join(w + mark for w in words), "en", "s0", 0))
    return spark.createDataFrame(rows, SCHEMA)


def test_outliers_go_and_clean_texts_stay(spark):
    got = {r.doc_id: r.kept for r in Q.judge(_corpus(spark)).collect()}
    assert all(kept for i, kept in got.items() if i < 2000)
    assert not any(kept for i, kept in got.items() if i >= 2000)


def test_estimates_equal_numpy(spark):
    """The C-steps from both starts, written with matrices."""
    stats = Q._vector(Q.text_statistics(_corpus(spark)))
    rows = stats.where("not base_failed").withColumn("cell", F.col("source")).select("cell", *Q.X)
    rows = rows.cache()
    counts = rows.groupBy("cell").agg(F.count("*").alias("n"))
    got = {r["cell"]: r for r in Q.robust_estimates(rows, counts).collect()}
    floor = np.diag([Q.FLOORS[x] ** 2 for x in Q.X])
    for cell, r in got.items():
        x = np.array([list(v)[1:] for v in rows.where(F.col("cell") == cell).collect()])
        q = np.percentile(x, [25, 50, 75], axis=0)
        starts = [(x.mean(0), np.cov(x.T, bias=True) + floor),
                  (q[1], np.diag(((q[2] - q[0]) / 1.349) ** 2) + floor)]
        best = None
        for m, c in starts:
            for _ in range(Q.STEPS):
                d2 = np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)
                bins = np.floor(np.log(d2 + 1e-6) * 32)
                inside, cut = 0, None
                for b in np.unique(bins):
                    if inside < Q.KEEP_SHARE * len(x):
                        cut = b
                    inside += (bins == b).sum()
                near = x[bins <= cut]
                m = near.mean(0)
                c = np.cov(near.T, bias=True) * Q.consistency(Q.KEEP_SHARE) + floor
            if best is None or np.linalg.det(c) < np.linalg.det(best[1]) - 1e-15:
                best = m, c
        assert np.allclose([r[f"m_{i}"] for i in range(4)], best[0], atol=1e-6)
        low = np.zeros((4, 4))
        for i, j in Q.PAIRS:
            low[i, j] = r[f"l_{i}_{j}"]
        assert np.allclose(low @ low.T, best[1], atol=1e-6)


def test_a_small_source_is_judged_by_its_own_style(spark):
    rows = [(i, prose(i + 1, 60 + i % 60), "en", f"s{i % 7}", 0) for i in range(420)]
    for i in range(43):                # long words; three of them with symbols
        words = [w * 2 + "%%%" * (i >= 40) for w in prose(9000 + i, 60 + i).split()]
        rows.append((1000 + i, " ".join(words), "en", "own", 0))
    got = {r.doc_id: r.kept for r in Q.judge(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [i for i, kept in got.items() if kept != (i < 1040)] == []


def test_a_source_counts_more_with_each_row(spark):
    """No jump: one more row moves the estimate by a small part of the way."""
    names = [f"m_{i}" for i in range(4)] + [f"l_{i}_{j}" for i, j in Q.PAIRS]
    unit = [0.0] * 4 + [0.1 * (i == j) for i, j in Q.PAIRS]
    cells = [(f"2{n}", *([1.0] + unit[1:])) for n in range(Q.MIN_CELL, 400)] + [("1", *unit)]
    estimates = spark.createDataFrame(cells, ["cell", *names])
    links = spark.createDataFrame([(f"2{n}", "1", n) for n in range(Q.MIN_CELL, 400)],
                                  "cell string, lang_cell string, passed long")
    got = {r["cell"]: r for r in Q._shrunk(estimates, links).collect()}
    centre = np.array([0.0] + [got[f"2{n}"].m_0 for n in range(Q.MIN_CELL, 400)])
    assert 0 < np.diff(centre).min() and np.diff(centre).max() < 0.04 and centre[-1] > 0.9
    assert got["1"].m_0 == 0.0 and abs(got["1"].l_0_0 - 0.1) < 1e-12
    assert abs(got["2399"].l_1_1 - 0.1) < 1e-9 and got["2399"].l_0_0 > 0.1


def test_small_sources_are_pooled_and_nulls_are_values(spark):
    rows = [(i, prose(i + 1, 80), None if i % 2 else "en", f"s{i % 40}", 0) for i in range(700)]
    df = spark.createDataFrame(rows, SCHEMA)
    cells = Q._with_cells(Q._vector(Q.text_statistics(df))).groupBy("cell").count().collect()
    assert sorted((r["cell"], r["count"]) for r in cells) == [
        ("1{\"lang\":\"en\"}", 350), ("1{}", 350)]


def test_empty_table(spark):
    assert Q.judge(empty_frame(spark)).count() == 0
