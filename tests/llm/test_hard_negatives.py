"""Hard negatives against all scores; the tree against plain search."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, is_anchor, positives=5, negatives=5, low=80):
    sound = [(i, [math.floor(256 * x) for x in v], y) for i, v, y in rows if y is not None
             and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for place, (i, v, y) in enumerate(sound):
        if i is None or not is_anchor(i):
            continue
        scored = sorted(((-sum(a * b for a, b in zip(v, w, strict=False)), j is None, j or 0, z)
                         for other, (j, w, z) in enumerate(sound) if other != place))
        near = [x for x in scored if x[3] == y][:positives]
        for p in near:
            found = [x for x in scored if x[3] != y and -low * p[0] <= -100 * x[0] <= -100 * p[0]]
            out += [(i, None if p[1] else p[2], r + 1, None if x[1] else x[2], -p[0], -x[0])
                    for r, x in enumerate(found[:negatives])]
    return sorted(out, key=repr)


def check(spark, rows, every=10):
    df = spark.createDataFrame(rows, SCHEMA)
    got = H.mine(df, F.col("vec_id") % every == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                           "negative_score"]
    rows = [tuple(r) for r in df.collect()]                   # as floats
    want = brute(rows, lambda i: i % every == 0)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    return want


def vectors(n, dims, seed=1, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels * 2, dims))
    out = []
    for i in range(n):
        v = centres[i % len(centres)] + 0.8 * rng.normal(size=dims)
        out.append((i, [float(x) for x in v / np.linalg.norm(v)], int(rng.integers(labels))))
    return out


@pytest.mark.parametrize("kind", [np.float64, np.int64])
def test_tree_by_plain_search(kind):
    rng = np.random.default_rng(3)
    for n, dims in [(1, 3), (64, 2), (65, 1), (3000, 5), (1500, 16)]:
        points = rng.integers(-40, 40, (n, dims)).astype(kind)
        labels = rng.integers(0, 3, n)
        tree = H.RTree(points, labels)
        assert sorted(tree.order) == list(range(n))
        anchors = rng.integers(-40, 40, (6, dims)).astype(kind)
        least, greatest = tree.intervals(anchors)
        for level in range(len(tree.counts)):
            assert (tree.low[tree.base[level]:tree.base[level + 1]].min(axis=0) == points.min(axis=0)).all()
        for q, a in enumerate(anchors):
            scores = points @ a
            assert (least[q][-1] <= scores).all() and (scores <= greatest[q][-1]).all()
            for same in (True, False):
                for window in [(-np.inf, np.inf), (0, int(np.median(scores)) + 50), (10 ** 6, 10 ** 7)]:
                    ok = [i for i in range(n) if (labels[i] == 1) == same
                          and window[0] <= scores[i] <= window[1]]
                    want = sorted(ok, key=lambda i: (-scores[i], i))[:5]
                    places, got = tree.best(a, least[q], greatest[q], 1, same, window, 5, tree.order)
                    assert tree.order[places].tolist() == want
                    assert got.tolist() == [scores[i] for i in want]


def test_boxes_outside_are_not_opened():
    points = np.arange(6400, dtype=np.float64)[:, None]
    tree = H.RTree(points, np.zeros(6400, np.int64))
    opened = []
    rows = tree.rows[0]
    tree.rows[0] = (type("Seen", (), {"__getitem__": lambda s, p: opened.append(int(p)) or rows[0][p]})(), rows[1])
    least, greatest = tree.intervals(np.ones((1, 1)))
    places, got = tree.best(np.ones(1), least[0], greatest[0], 0, True, (3000, 3003), 5, tree.order)
    assert sorted(got) == [3000, 3001, 3002, 3003] and len(opened) <= 2


def test_all_scores(spark):
    assert len(check(spark, vectors(600, 12))) > 300


def test_blocks_of_anchors(spark, monkeypatch):
    monkeypatch.setattr(H, "ANCHORS_PER_BLOCK", 7)
    monkeypatch.setattr(H, "ANCHORS_AT_ONCE", 3)
    check(spark, vectors(300, 6, 2), 5)


def test_a_third_are_one_vector(spark):
    rows = vectors(240, 6, 5)
    check(spark, [(i, rows[0][1] if i % 3 == 0 else v, y) for i, v, y in rows])


def test_repeated_and_negative_rows(spark):
    rows = vectors(60, 4, 7)
    check(spark, rows + rows[:20] + rows[:10])
    check(spark, [(i, [-abs(x) if i == 0 else abs(x) for x in v], y) for i, v, y in rows], 60)


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5], 1), (10, [1.0], 1), (1, [], 1), (2, None, 1), (3, [1.0, None], 2),
            (4, [nan, 1.0], 2), (5, [inf, 1.0], 2), (6, [0.9, 0.4], None), (7, [0.9, 0.5], 2),
            (None, [0.95, 0.5], 2), (None, [1.0, 0.5], 1), (8, [3e4, 2e4, 1.0], 3), (20, [], 2)]
    check(spark, rows)
    check(spark, [(i, [x * 1e6 for x in v or []], y) for i, v, y in rows if i == 0 or i == 7 or i == 10])
    empty = spark.createDataFrame([], SCHEMA)
    assert H.mine(empty, F.col("vec_id") % 10 == 0).count() == 0
    df = spark.createDataFrame(rows, SCHEMA).withColumns(
        {c: F.lit("clash") for c in ("id", "v", "anchor", "rank", "query", "score")})
    assert H.mine(df, F.col("vec_id") % 10 == 0).count() == H.mine(
        df.select("vec_id", "embedding", "label"), F.col("vec_id") % 10 == 0).count()
