"""Toxicity severity by cumulative-link ordinal regression (operator 10).

Grades 0 < 1 < 2 share one weight vector over sparse text features (words and
word beginnings); each threshold between grades has its own intercept:
``P(grade <= k) = sigmoid(threshold_k - weights . features)``.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType, DoubleType, IntegerType, StructField, StructType,
)

from tessera.llm.common import materialize, ship_package, text_or_empty

TRAIN_ROWS = 12_000      # labelled documents the model is fitted on, half of either class, by hash, about
MIN_DOCS = 4             # sample documents that must hold a feature
PREFIX = 4               # bytes of a word's beginning
STEPS, RATE, DECAY = 150, 0.3, 2e-5
WORD = re.compile(rb"[a-z0-9\x80-\xff]+")
TELLING = 4.0            # z-score from which a feature tells toxic documents apart


def features(text: bytes) -> set[bytes]:
    """Distinct words (A-Z lower-cased) and beginnings of longer words."""
    words = set(WORD.findall(text.lower()))
    return words | {b"^" + w[:PREFIX] for w in words if len(w) > PREFIX}


def severity_grades(rows: list[np.ndarray], toxic: np.ndarray, width: int) -> np.ndarray:
    """Grades from yes/no labels: 0 for documents that are not toxic; toxic
    ones are 2 if at least half of them have a smaller share of telling
    features, else 1.  Telling features are much more frequent (z-score) in
    toxic documents than in the others."""
    n1, n0 = toxic.sum(), (~toxic).sum()
    c1 = np.bincount(np.concatenate([r for r, t in zip(rows, toxic, strict=True) if t]),
                     minlength=width)
    c0 = np.bincount(np.concatenate([r for r, t in zip(rows, toxic, strict=True) if not t]),
                     minlength=width)
    p = (c1 + c0 + 1) / (n1 + n0 + 2)
    z = (c1 / n1 - c0 / n0) / np.sqrt(p * (1 - p) * (1 / n1 + 1 / n0))
    telling = z > TELLING
    share = np.array([telling[r].mean() if len(r) else 0.0 for r in rows])
    return np.where(toxic, 1 + (share >= np.median(share[toxic])), 0)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def loss_and_gradients(w: np.ndarray, cut: np.ndarray, doc: np.ndarray, col: np.ndarray,
                       value: np.ndarray, grades: np.ndarray,
                       copies: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean negative log-likelihood of the grades, with the decay of the
    weights, and its gradients.  ``doc``, ``col``, ``value``: the documents'
    features; ``cut``: the first threshold, then logs of the steps up."""
    top, n = len(cut), copies.sum()
    steps = np.exp(cut[1:])
    theta = np.r_[-np.inf, cut[0] + np.r_[0, np.cumsum(steps)], np.inf]
    eta = np.bincount(doc, weights=w[col] * value, minlength=len(grades))
    hi, lo = _sigmoid(theta[grades + 1] - eta), _sigmoid(theta[grades] - eta)
    hi[grades == top], lo[grades == 0] = 1.0, 0.0
    p = np.maximum(hi - lo, 1e-12)
    f_hi, f_lo = hi * (1 - hi), lo * (1 - lo)
    slope = copies * (f_hi - f_lo) / p / n
    g_w = np.bincount(col, weights=slope[doc] * value, minlength=len(w)) + DECAY * w
    g_theta = np.zeros(top)
    np.add.at(g_theta, grades[grades < top], -(copies * f_hi / p)[grades < top] / n)
    np.add.at(g_theta, grades[grades > 0] - 1, (copies * f_lo / p)[grades > 0] / n)
    upward = np.cumsum(g_theta[::-1])[::-1]       # a step moves all later thresholds
    loss = -(copies * np.log(p)).sum() / n + DECAY * (w * w).sum() / 2
    return float(loss), g_w, np.r_[upward[0], upward[1:] * steps]


def fit(rows: list[np.ndarray], sizes: np.ndarray, grades: np.ndarray, width: int,
        copies: np.ndarray | None = None):
    """Weights and thresholds by full-batch Adam.  A feature's value in a
    document is its rarity (log of documents per document that holds it, over
    the mean of that) / sqrt(number of the document's features); the weights
    returned include the rarity.  A document counts ``copies`` times."""
    copies = np.ones(len(rows)) if copies is None else copies
    n = copies.sum()
    doc = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    col = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    held = np.bincount(col, weights=copies[doc], minlength=width)
    rarity = np.log((n + 1) / np.maximum(held, 1))
    rarity /= max(rarity.mean(), 1e-9) if width else 1.0
    value = rarity[col] / np.sqrt(np.maximum(sizes, 1))[doc]
    top = int(grades.max())
    below = np.array([copies[grades <= k].sum() / n for k in range(top)])
    first = np.log(below / (1 - below))
    # thresholds: the first, then logs of the steps up, so they stay ordered
    w, cut = np.zeros(width), np.r_[first[0], np.log(np.maximum(np.diff(first), 1e-2))]
    m = [np.zeros(width), np.zeros(top)]
    v = [np.zeros(width), np.zeros(top)]
    for step in range(1, STEPS + 1):
        _, *gradients = loss_and_gradients(w, cut, doc, col, value, grades, copies)
        for k, (x, g) in enumerate(zip((w, cut), gradients, strict=True)):
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.999 * v[k] + 0.001 * g * g
            x -= RATE * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    return w * rarity, cut[0] + np.r_[0, np.cumsum(np.exp(cut[1:]))]


def expected(eta: np.ndarray, theta: np.ndarray) -> np.ndarray:
    """Expected grade: the sum over thresholds of the chance to be above."""
    return (1 / (1 + np.exp(np.clip(theta[None, :] - eta[:, None], -30, 30)))).sum(axis=1)


def best_cut(severities: np.ndarray, toxic: np.ndarray,
             copies: np.ndarray | None = None) -> float:
    """The severity from which on documents are called toxic: highest F1 on
    the given ones, in the middle of the gap where it lies.  A document counts
    ``copies`` times."""
    copies = np.ones(len(toxic)) if copies is None else copies
    order = np.argsort(-severities, kind="stable")
    s, hits = severities[order], np.cumsum((toxic * copies)[order])
    f1 = 2 * hits / (np.cumsum(copies[order]) + (toxic * copies).sum())
    at = int(f1.argmax())
    return float((s[at] + s[at + 1]) / 2 if at + 1 < len(s) else s[at])


def train(documents: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
          train_rows: int) -> tuple[dict[bytes, float], list[float], float] | None:
    """(weights, thresholds, cut), or None where the labels of all documents
    are of one class.  ``cut`` is the severity from which on a document is
    called toxic; it is chosen on every fifth sample document, which the fit
    leaves out.

    About ``train_rows`` labelled documents, half of either class (more of one
    where the other has fewer), chosen by a hash of the id, are turned into
    features where they lie; of several texts of one id the one with the least
    hash counts.  The feature lists, bounded
    by that number, meet in one task, which fits the model.  There each counts
    as many times as its class is larger than its sample.
    """
    known = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
             .groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col) > 0).alias("toxic")))
    marked = materialize(known.join(
        documents.select(F.col(id_col).alias("id")).distinct(), "id", "left_semi"), "toxicity-labels")
    every = {r["toxic"]: r["n"] for r in marked.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(every) < 2:
        return None
    shares = {c: min(1.0, max(train_rows / 2, train_rows - every[not c]) / every[c]) for c in every}
    share = F.when(F.col("toxic"), shares[True]).otherwise(shares[False])
    chosen = marked.where((share >= 1) | (
        F.shiftrightunsigned(F.xxhash64("id"), 1) < share * 2.0 ** 63))
    texts = documents.select(F.col(id_col).alias("id"),
                             text_or_empty(text_col).cast("binary").alias("text"))
    # bounded by train_rows, a parameter
    sample = texts.join(F.broadcast(chosen), "id").select(
        "id", "text", "toxic", F.xxhash64("text").alias("h"))

    def extract(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([sorted(features(t.as_py())) for t in b.column(1)],
                                       pa.list_(pa.binary())), b.column(2), b.column(3)],
                names=["id", "features", "toxic", "h"])

    def learn(batches):
        number: dict[bytes, int] = {}
        rows, toxic = [], []
        for b in batches:
            for words, t in zip(b.column(0), b.column(1), strict=True):
                rows.append(np.array([number.setdefault(w, len(number))
                                      for w in words.as_py()], np.int64))
                toxic.append(bool(t.as_py()))
        marks = np.array(toxic, bool)
        if marks.any() and not marks.all():
            sizes = np.array([len(r) for r in rows], np.float64)
            copies = np.where(marks, 1 / shares[True], 1 / shares[False])
            seen = np.bincount(np.concatenate(rows), minlength=len(number))
            new = np.where(seen >= MIN_DOCS, np.cumsum(seen >= MIN_DOCS) - 1, -1)
            rows = [new[r][new[r] >= 0] for r in rows]
            width = int((seen >= MIN_DOCS).sum())
            out = np.arange(len(rows)) % 5 == 4
            if marks[~out].all() or not marks[~out].any() or not marks[out].any():
                out[:] = False
            kept = [r for r, o in zip(rows, out, strict=True) if not o]
            w, theta = fit(kept, sizes[~out], severity_grades(kept, marks[~out], width), width,
                           copies[~out])
            judged = out if out.any() else ~out
            eta = np.array([w[r].sum() / math.sqrt(max(1, n)) for r, n, j in
                            zip(rows, sizes, judged, strict=True) if j])
            cut = best_cut(expected(eta, theta), marks[judged], copies[judged])
            names = [k for k, i in number.items() if new[i] >= 0]
            for at in range(0, width, 4096):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[at:at + 4096], pa.binary()), pa.array(w[at:at + 4096])],
                    names=["feature", "weight"])
            yield pa.RecordBatch.from_arrays([pa.array([b""], pa.binary()), pa.array([cut])],
                                             names=["feature", "weight"])
            yield pa.RecordBatch.from_arrays(
                [pa.array([None] * len(theta), pa.binary()), pa.array(theta)],
                names=["feature", "weight"])

    lists = sample.mapInArrow(extract, StructType([
        texts.schema[0], *_schema("features array<binary>, toxic boolean, h long")]))
    one = lists.groupBy("id").agg(F.min_by(F.struct("features", "toxic"), "h").alias("b"))
    rows = (one.select("id", "b.*").repartition(1).sortWithinPartitions("id").select("features", "toxic")
            .mapInArrow(learn, "feature binary, weight double").collect())
    theta = sorted(r["weight"] for r in rows if r["feature"] is None)
    if not theta:
        return None
    weights = {bytes(r["feature"]): r["weight"] for r in rows if r["feature"] is not None}
    return weights, theta, weights.pop(b"")


def _schema(ddl: str) -> list[StructField]:
    return list(StructType.fromDDL(ddl))


def severity(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "toxic", train_rows: int = TRAIN_ROWS) -> DataFrame:
    """One row per input row: the id, ``severity`` (expected grade, 0 to 2),
    ``grade`` (the most likely one), ``p_toxic`` (grade above 0) and ``toxic``
    (severity at or above the cut chosen on held-out labelled documents).

    Texts are read whole; null text counts as empty; null ids pass through;
    repeated rows each get their row; labels with null id or label are left
    out, of several labels of one id the worst counts, of several texts of one
    id the one with the least hash trains; an empty table gives no rows.  Where the labels of all these documents are of one class, nothing
    is toxic: severity 0.
    """
    ship_package(df.sparkSession)
    model = train(df, labels, id_col, text_col, label_col, train_rows)
    shared = df.sparkSession.sparkContext.broadcast(model)
    src = df.select(F.col(id_col), text_or_empty(text_col).cast("binary").alias("__text"))
    schema = StructType([src.schema[0], StructField("severity", DoubleType()),
                         StructField("grade", IntegerType()), StructField("p_toxic", DoubleType()),
                         StructField("toxic", BooleanType())])

    def score(text: bytes) -> tuple[float, int, float]:
        if shared.value is None:
            return 0.0, 0, 0.0
        weights, theta, _ = shared.value
        found = features(text)
        eta = sum(map(weights.get, found & weights.keys())) / math.sqrt(max(1, len(found)))
        above = [1 / (1 + math.exp(min(30.0, max(-30.0, t - eta)))) for t in theta]
        chances = [a - b for a, b in zip([1.0, *above], [*above, 0.0], strict=True)]
        return sum(above), max(range(len(chances)), key=chances.__getitem__), above[0]

    def run(batches):
        cut = shared.value[2] if shared.value else math.inf
        for b in batches:
            done = [score(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([d[0] for d in done], pa.float64()),
                 pa.array([d[1] for d in done], pa.int32()),
                 pa.array([d[2] for d in done], pa.float64()),
                 pa.array([d[0] >= cut for d in done], pa.bool_())],
                names=[f.name for f in schema])

    return src.mapInArrow(run, schema)
