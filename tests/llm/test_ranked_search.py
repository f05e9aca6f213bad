"""Ranked search against scores of all documents; the treap against sums."""

import math
import random
import re
from collections import Counter

import numpy as np

from tessera.llm import ranked_search as R
from tests.llm.rows import SCHEMA, clashing, edge_frame, empty_frame, prose


def terms(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute(docs, queries, k):
    held = [(i, Counter(terms(t))) for i, t in docs]
    sizes = [sum(c.values()) for _, c in held]
    total, length = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(t for _, c in held for t in c)
    out = []
    for q, text in set(queries):
        w = {t: math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) for t in set(terms(text))}
        scored = []
        for (i, c), n in zip(held, sizes, strict=True):
            m = 100 - 90 + (90 * n * total) // max(1, length)
            s = sum(w[t] * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in w if c[t])
            if s > 0:
                scored.append((-s, i is None, i))
        scored.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(q, r + 1, i, -s) for r, (s, _, i) in enumerate(scored[:k])]
    return sorted(out, key=repr)


def check(df, queries, k=10):
    got = R.rank(df, queries, k)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    want = brute([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()],
                 [(r.item_id, r.text) for r in queries.select("item_id", "text").collect()], k)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    return want


def asked(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_treap_by_sums():
    rng = np.random.default_rng(1)
    for n, t, k in [(1, 1, 1), (7, 3, 2), (300, 40, 5), (2000, 9, 10), (5, 600, 3)]:
        grid = np.where(rng.random((t, n)) < 0.3, rng.integers(1, 50, (t, n)), 0)
        rows, columns = np.nonzero(grid)
        treap = R.Treap(rows, columns, grid[rows, columns])
        for _ in range(10):
            q = rng.choice(t + 40, min(t, 6), replace=False)      # also rows without a point
            sums = grid[q[q < t]].sum(axis=0)
            order = sorted(range(n), key=lambda c: (-sums[c], c))[:k]
            want = [(int(sums[c]), c) for c in order if sums[c] > 0]
            assert treap.best(q, k, 0) == want
            if want:
                least = want[-1][0]
                assert treap.best(q, k, least + 1) == [x for x in want if x[0] > least]
    assert R.Treap(*[np.zeros(0, np.int64)] * 3).best(np.array([0, 1]), 3, 0) == []


def test_ranks_of_prose(spark):
    rng = random.Random(4)
    docs = [(i * 7 % 500, prose(i % 90, rng.randint(0, 120))) for i in range(500)]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in docs], SCHEMA).repartition(5)
    queries = asked(spark, [(i, prose(i, 25) + " absent") for i in range(40)])
    assert len(check(df, queries)) > 300
    check(df, queries, 1)


def test_few_ranges_at_once_and_blocks_of_queries(spark, monkeypatch):
    monkeypatch.setattr(R, "RANGES_AT_ONCE", 1)
    monkeypatch.setattr(R, "QUERIES_PER_BLOCK", 4)
    df = spark.createDataFrame([(i, prose(i % 20, 60), "en", "s", 0) for i in range(100)], SCHEMA)
    check(df, asked(spark, [(i, prose(i, 12)) for i in range(10)]), 3)


def test_equal_scores_go_by_id(spark):
    df = spark.createDataFrame([(i, "same words here", "en", "s", 0) for i in range(60)]
                               + [(100, "other", "en", "s", 0)] * 80, SCHEMA).repartition(6)
    want = check(df, asked(spark, [(1, "same WORDS"), (2, "other")]))
    assert [d for q, _, d, _ in sorted(want) if q == 1] == list(range(10))


def test_edge_rows(spark):
    queries = asked(spark, [(1, None), (2, ""), (3, "alpha2 beta5 X"), (None, prose(2, 40)),
                            (4, prose(2, 40)), (4, prose(2, 40)), (4, "x É 中"), (5, "A" * 50_000)])
    df = clashing(edge_frame(spark), "doc", "n", "terms", "counts", "query", "rank", "score", "item_id")
    check(df, queries)
    assert R.rank(empty_frame(spark), queries).count() == 0
    assert R.rank(df, queries.limit(0)).count() == 0
