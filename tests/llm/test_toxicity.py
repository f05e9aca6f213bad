"""Toxicity: gradients, held-out accuracy, edge rows."""

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import toxicity as T
from tests.llm.rows import SCHEMA, clashing, edge_frame, empty_frame, prose

LABELS = "doc_id long, quality int, toxic int"


VILE = ["vileword", "nastyterm", "foulname", "grubby", "weaselly", "toadface", "ratbag",
        "slimeball", "muckrake", "boorish", "lout", "oafish"]


def planted(spark, n=600):
    docs, labels = [], []
    for i in range(n):
        words = prose(i, 120).split()
        bad = i % 7 == 0
        if bad:
            for k in range(9):
                words[11 * k + 3] = VILE[(i + k * (1 + i % 3)) % len(VILE)]
        docs.append((i, " ".join(words), "en", "s", 0))
        if i % 2 == 0 or i % 7 == 0 and i % 3 == 0:
            labels.append((i, 1, int(bad)))
    return spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, LABELS)


def test_held_out_documents(spark):
    docs, labels = planted(spark)
    seen = {r.doc_id for r in labels.collect()}
    rows = T.severity(docs, labels).collect()
    held = [r for r in rows if r.doc_id not in seen]
    assert len(held) > 200
    assert all(r.toxic for r in held if r.doc_id % 7 == 0)
    assert sum(r.toxic for r in held if r.doc_id % 7) <= 0.02 * len(held)
    assert all(0 <= r.severity <= 2 and r.grade in (0, 1, 2) for r in rows)


def test_thresholds_are_ordered_and_weights_shared():
    rng = np.random.default_rng(0)
    rows = [rng.choice(50, 8, replace=False) for _ in range(400)]
    score = np.array([np.isin(r, range(5)).sum() for r in rows])
    grades = np.minimum(score, 2)
    w, theta = T.fit(rows, np.full(400, 8.0), grades, 50)
    assert theta[0] < theta[1] and w[:5].min() > w[5:].max()
    eta = np.array([w[r].sum() / 8 ** 0.5 for r in rows])
    severity = T.expected(eta, theta)
    means = [severity[grades == g].mean() for g in range(3)]
    assert means[0] < 0.6 < means[1] < means[2]


def test_gradients_by_finite_differences():
    rng = np.random.default_rng(2)
    rows = [rng.choice(12, rng.integers(1, 6), replace=False) for _ in range(40)]
    doc, col = np.repeat(np.arange(40), [len(r) for r in rows]), np.concatenate(rows)
    value, copies = rng.random(len(col)) + 0.1, rng.integers(1, 4, 40).astype(float)
    grades = rng.integers(0, 4, 40)
    w, cut = rng.normal(size=12), np.array([-0.3, 0.1, -0.5])

    def loss(w, cut):
        """The likelihood written out, document by document."""
        theta = [-np.inf, cut[0], cut[0] + np.exp(cut[1]), cut[0] + np.exp(cut[1]) + np.exp(cut[2]), np.inf]
        total = 0.0
        for i in range(40):
            eta = sum(w[c] * v for c, v, d in zip(col, value, doc, strict=True) if d == i)
            below = [1 / (1 + np.exp(eta - t)) for t in theta]
            total -= copies[i] * np.log(below[grades[i] + 1] - below[grades[i]])
        return total / copies.sum() + T.DECAY * (w ** 2).sum() / 2

    got, g_w, g_cut = T.loss_and_gradients(w, cut, doc, col, value, grades, copies)
    assert abs(got - loss(w, cut)) < 1e-9
    for x, g in ((w, g_w), (cut, g_cut)):
        for k in range(len(x)):
            ends = []
            for d in (1e-5, -1e-5):
                x[k] += d
                ends.append(loss(w, cut))
                x[k] -= d
            assert abs((ends[0] - ends[1]) / 2e-5 - g[k]) < 1e-6


def test_one_id_under_several_texts(spark):
    """The text with the least hash trains, however the rows are dealt."""
    docs, labels = planted(spark, 300)
    twice = docs.unionByName(docs.withColumn("text", F.concat(F.lit("second "), F.reverse("text"))))
    rows = [sorted(tuple(r) for r in T.severity(df, labels).collect())
            for df in (twice.repartition(3), twice.orderBy(F.desc("text")).repartition(8))]
    assert rows[0] == rows[1] and len(rows[0]) == 600


def test_few_toxic_labels_among_many(spark):
    """14 of 3,000 labels are toxic; a sample of 200 over both classes would
    expect one of them."""
    docs, bad = [], lambda i: i % 200 == 7
    for i in range(3600):
        words = prose(i, 60).split()
        if bad(i):
            for k in range(9):
                words[6 * k + 3] = VILE[(i // 200 + k) % len(VILE)]
        docs.append((i, " ".join(words), "en", "s", 0))
    labels = spark.createDataFrame([(i, 1, int(bad(i))) for i in range(3000)], LABELS)
    rows = T.severity(spark.createDataFrame(docs, SCHEMA), labels, train_rows=200).collect()
    found = {r.doc_id for r in rows if r.toxic}
    assert {i for i in range(3600) if bad(i)} <= found and len(found) <= 18 + 10


def test_copies_count_like_repeated_rows():
    rng = np.random.default_rng(1)
    rows = [rng.choice(30, 6, replace=False) for _ in range(60)]
    grades = np.array([min(2, int(np.isin(r, range(4)).sum())) for r in rows])
    copies = rng.integers(1, 5, 60)
    many = np.repeat(np.arange(60), copies)
    one = T.fit(rows, np.full(60, 6.0), grades, 30, copies.astype(float))
    all_ = T.fit([rows[i] for i in many], np.full(len(many), 6.0), grades[many], 30)
    assert np.allclose(one[0], all_[0], atol=1e-3) and np.allclose(one[1], all_[1], atol=1e-3)
    s = rng.permutation(60) / 60
    assert T.best_cut(s, grades > 0, copies.astype(float)) == T.best_cut(s[many], grades[many] > 0)


def test_best_cut():
    assert T.best_cut(np.array([0.1, 0.2, 0.8, 0.9]), np.array([False, False, True, True])) == 0.5


def test_edge_rows(spark):
    docs, labels = planted(spark, 400)
    df = clashing(edge_frame(spark).union(docs.withColumn("doc_id", F.col("doc_id") + 100)),
                  "severity", "toxic", "__text", "features")
    more = labels.withColumn("doc_id", F.col("doc_id") + 100).union(spark.createDataFrame(
        [(None, 1, 1), (1, 1, None), (2, 1, 0), (2, 1, 0), (99999, 0, 1)], LABELS))
    rows = T.severity(df, clashing(more, "text", "id")).collect()
    assert len(rows) == df.count()
    bad = {i + 100 for i in range(400) if i % 7 == 0}
    assert len({r.doc_id for r in rows if r.toxic} ^ bad) <= 8


def test_one_class_or_no_rows(spark):
    df = edge_frame(spark)
    none = spark.createDataFrame([(1, 1, 0), (2, 1, 0)], LABELS)
    assert {(r.severity, r.toxic) for r in T.severity(df, none).collect()} == {(0.0, False)}
    assert {(r.severity, r.toxic) for r in T.severity(df, none.limit(0)).collect()} == {(0.0, False)}
    assert T.severity(empty_frame(spark), none).count() == 0
