"""Hard-negative mining over STR-packed R-trees (operator 13).

Vectors are dealt into slabs by label and first component; every batch of a
slab is tiled into pages by sort-tile-recursive packing, and pages into nodes.
A node's minimum bounding box gives an interval for each coordinate's share of
the inner product with an anchor, hence one for the whole.  A search opens the
nodes with the highest upper ends first and leaves those outside the score
window or strictly below the k-th score found.  Anchors are taken in bounded
blocks, every block against all rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import materialize, ship_package

PAGE = 64                    # vectors of a page
FAN = 8                      # children of a node
NODES_AT_ONCE = 32           # pages that one step of a search opens
ANCHORS_PER_BLOCK = 10_000
ANCHORS_AT_ONCE = 1_024      # anchors whose intervals are held together


def _tiles(vectors: np.ndarray, rows: np.ndarray, axes: list[int]) -> list[np.ndarray]:
    """Sort-tile-recursive: ``rows`` sorted by the first axis, cut into slabs
    of whole pages, each slab tiled by the axes after it."""
    pages = -(-len(rows) // PAGE)
    rows = rows[np.argsort(vectors[rows, axes[0]], kind="stable")] if axes else rows
    if len(axes) <= 1 or pages <= 1:
        return [rows[i:i + PAGE] for i in range(0, len(rows), PAGE)]
    slabs = int(np.ceil(pages ** (1 / len(axes))))
    wide = -(-pages // slabs) * PAGE
    return [p for i in range(0, len(rows), wide) for p in _tiles(vectors, rows[i:i + wide], axes[1:])]


class RTree:
    """R-tree over one batch: ``vectors`` and ``labels`` in page order."""

    def __init__(self, vectors: np.ndarray, labels: np.ndarray):
        pages = []
        spread = np.argsort(-np.ptp(vectors, axis=0), kind="stable") if vectors.shape[1] else []
        for label in np.unique(labels):
            rows = np.flatnonzero(labels == label)
            depth = max(1, int(np.log2(max(2, len(rows) / PAGE))))
            pages += _tiles(vectors, rows, list(spread[:depth]))
        self.order = np.concatenate(pages)
        self.vectors, self.labels = vectors[self.order], labels[self.order]
        first = np.cumsum([0] + [len(p) for p in pages])
        self.rows = [(first[:-1], first[1:])]                   # by level, pages first
        low = [np.minimum.reduceat(self.vectors, first[:-1], axis=0)]
        high = [np.maximum.reduceat(self.vectors, first[:-1], axis=0)]
        some = [np.minimum.reduceat(self.labels, first[:-1])]
        most = [np.maximum.reduceat(self.labels, first[:-1])]
        self.counts = [len(pages)]
        while self.counts[-1] > 1:
            cut = np.arange(0, self.counts[-1], FAN)
            low.append(np.minimum.reduceat(low[-1], cut, axis=0))
            high.append(np.maximum.reduceat(high[-1], cut, axis=0))
            some.append(np.minimum.reduceat(some[-1], cut))
            most.append(np.maximum.reduceat(most[-1], cut))
            self.counts.append(len(cut))
        self.low, self.high = np.concatenate(low), np.concatenate(high)
        self.some, self.most = np.concatenate(some), np.concatenate(most)
        self.base = np.cumsum([0, *self.counts])

    def intervals(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest inner product that each node's box allows."""
        up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
        return (up @ self.low.T + down @ self.high.T, up @ self.high.T + down @ self.low.T)

    def children(self, nodes: np.ndarray) -> np.ndarray:
        level = np.searchsorted(self.base, nodes, side="right") - 1
        inside = (nodes - self.base[level])[:, None] * FAN + np.arange(FAN)
        real = inside < np.array(self.counts)[level - 1][:, None]
        return (inside + self.base[level - 1][:, None])[real]

    def best(self, anchor: np.ndarray, least: np.ndarray, greatest: np.ndarray, label: int,
             same: bool, window: tuple, k: int, tie: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, scores) of the ``k`` highest scores inside ``window``
        among the rows that have ``label`` (``same``) or another one; equal
        scores by ``tie``.  ``least``, ``greatest``: the nodes' intervals."""
        floor, top = window
        if same:
            fits = (self.some <= label) & (label <= self.most)
        else:
            fits = (self.some != label) | (self.most != label)
        fits = fits & (greatest >= floor) & (least <= top)
        queue = np.array([len(self.low) - 1])
        queue = queue[fits[queue]]
        places, scores = np.zeros(0, np.int64), np.zeros(0, anchor.dtype)
        while len(queue):
            if len(scores) == k:
                queue = queue[greatest[queue] >= scores[-1]]
            if len(queue) > NODES_AT_ONCE:
                cut = np.argpartition(-greatest[queue], NODES_AT_ONCE)
                now, queue = queue[cut[:NODES_AT_ONCE]], queue[cut[NODES_AT_ONCE:]]
            else:
                now, queue = queue, queue[:0]
            leaves, inner = now[now < self.counts[0]], now[now >= self.counts[0]]
            if len(inner):
                new = self.children(inner)
                queue = np.concatenate([queue, new[fits[new]]])
            if len(leaves):
                rows = np.concatenate([np.arange(self.rows[0][0][p], self.rows[0][1][p]) for p in leaves])
                got = self.vectors[rows] @ anchor
                ok = ((self.labels[rows] == label) == same) & (got >= floor) & (got <= top)
                if len(scores) == k:
                    ok &= got >= scores[-1]
                places = np.concatenate([places, rows[ok]])
                scores = np.concatenate([scores, got[ok]])
                order = np.lexsort((tie[places], -scores))[:k]
                places, scores = places[order], scores[order]
        return places, scores


def _matrix(lists: pa.Array, dims: int | None = None) -> np.ndarray:
    """Integer vectors as rows; shorter ones end in zeros."""
    sizes = np.diff(lists.offsets.to_numpy())
    dims = int(sizes.max(initial=0)) if dims is None else dims
    flat = lists.flatten().to_numpy()
    if len(sizes) and (sizes == dims).all():
        return flat.reshape(-1, dims)
    out = np.zeros((len(sizes), dims), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    column = np.arange(len(flat)) - np.repeat(lists.offsets.to_numpy()[:-1] - lists.offsets[0].as_py(), sizes)
    fit = column < dims
    out[row[fit], column[fit]] = flat[fit]
    return out


def _search(slabs: DataFrame, anchors: dict, same: bool, k: int) -> DataFrame:
    """(query, id, score, itself): each task's ``k`` best rows for each query;
    ``anchors`` has a vector, label, id and window for each."""
    sent = slabs.sparkSession.sparkContext.broadcast(anchors)
    kind = slabs.schema["id"].dataType.simpleString()

    def run(batches):
        a = sent.value
        for b in batches:
            if not b.num_rows:
                continue
            b = b.take(pc.sort_indices(b.column(0)))            # ties go by place; nulls last
            ids, labels = b.column(0), b.column(1).to_numpy().astype(np.int64)
            dims = max(a["vectors"].shape[1], max((len(x) for x in b.column(2)), default=0))
            vectors = _matrix(b.column(2), dims)
            sought = np.pad(a["vectors"], ((0, 0), (0, dims - a["vectors"].shape[1])))
            # doubles hold these sums exactly; otherwise 64-bit integers
            exact = dims * float(np.abs(vectors).max(initial=0)) * float(np.abs(sought).max(initial=0))
            kinds = np.float64 if exact < 2 ** 52 else np.int64
            vectors, sought = vectors.astype(kinds), sought.astype(kinds)
            tree = RTree(vectors, labels)
            queries, rows, scores, itself = [], [], [], []
            for start in range(0, len(sought), ANCHORS_AT_ONCE):
                least, greatest = tree.intervals(sought[start:start + ANCHORS_AT_ONCE])
                for i in range(start, min(start + ANCHORS_AT_ONCE, len(sought))):
                    for q, window in a["windows"][i]:
                        places, got = tree.best(sought[i], least[i - start], greatest[i - start],
                                                a["labels"][i], same, window, k, tree.order)
                        if len(places):
                            at = tree.order[places]
                            queries.append(np.full(len(at), q))
                            rows.append(at)
                            scores.append(got.astype(np.int64))
                            twin = (vectors[at] == sought[i]).all(axis=1) & (labels[at] == a["labels"][i])
                            itself.append(twin & np.array([ids[int(x)].as_py() == a["ids"][i] for x in at]))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(queries), pa.int64()),
                     ids.take(pa.array(np.concatenate(rows))), pa.array(np.concatenate(scores)),
                     pa.array(np.concatenate(itself))], names=["query", "id", "score", "itself"])

    found = slabs.mapInArrow(run, f"query long, id {kind}, score long, itself boolean")
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(df: DataFrame, anchor: Column, positives: int = 5, negatives: int = 5,
         low_percent: int = 80, scale: int = 256, id_col: str = "vec_id",
         vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """For each row that fulfils ``anchor`` and each of its positives, the
    hardest negatives inside the score window: ``anchor_id``, ``positive_id``,
    ``rank`` (from 1), ``negative_id``, ``positive_score``, ``negative_score``.

    A score is the inner product of the vectors in steps of 1/``scale``,
    rounded down; it must fit 64 bits.  Positives are the first ``positives``
    other rows of the anchor's label, negatives the first rows of other labels
    whose score is at least ``low_percent`` percent of the positive's and not
    above it; higher scores first, ties by smaller id (null ids last).  Rows
    with a null label, a null vector or a null, infinite or NaN component take
    no part.  Shorter vectors count as though they ended in zeros.  Repeated
    rows count each: a copy of the anchor is another row, and a repeated anchor
    has its result as often.  An empty table has an empty result.
    """
    spark = df.sparkSession
    ship_package(spark)
    vector = F.col(f"`{vector_col}`")
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x)
                     & (F.abs(x.cast("double")) < float("inf")))
    rows = (df.where(F.col(f"`{label_col}`").isNotNull() & vector.isNotNull() & sound)
            .select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("long").alias("label"),
                    F.transform(vector, lambda x: F.floor(scale * x.cast("double"))).alias("v"),
                    F.coalesce(anchor, F.lit(False)).alias("anchor")))
    slab = [F.col("label"), F.get("v", F.lit(0)), F.col("id"), F.xxhash64("v")]
    slabs = materialize(rows.repartitionByRange(*slab).sortWithinPartitions(*slab), "vector-slabs")
    anchors = materialize(slabs.where("anchor").groupBy("id", "label", "v").agg(
        F.count("*").alias("times")), "anchors")
    blocks = max(1, -(-anchors.count() // ANCHORS_PER_BLOCK))
    out = None
    for block in range(blocks):
        part = anchors if blocks == 1 else anchors.where(
            F.pmod(F.xxhash64("id", "label", "v"), F.lit(blocks)) == block)
        found = _block(slabs.drop("anchor"), part, positives, negatives, low_percent)
        if blocks > 1:
            found = materialize(found, "hard-negatives")
        out = found if out is None else out.union(found)
    return out


def _block(slabs: DataFrame, anchors: DataFrame, positives: int, negatives: int,
           low_percent: int) -> DataFrame:
    """``mine`` for one bounded block of anchors, which the driver holds."""
    spark = slabs.sparkSession
    held = anchors.collect()
    dims = max((len(r.v) for r in held), default=0)
    vectors = np.array([list(r.v) + [0] * (dims - len(r.v)) for r in held], np.int64).reshape(len(held), dims)
    known = {"vectors": vectors, "labels": [r.label for r in held], "ids": [r.id for r in held]}
    all_scores = [[(i, (-np.inf, np.inf))] for i in range(len(held))]
    # one more than asked for, as the anchor is among its own label's rows
    near = _search(slabs, known | {"windows": all_scores}, True, positives + 1)
    order = Window.partitionBy("query").orderBy("rank")
    own = F.max(F.when(F.col("itself"), -F.col("rank"))).over(Window.partitionBy("query"))
    other = (near.withColumn("own", -own).where("own is null or rank != own")
             .withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= positives)
             .select("query", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"),
                     "nth"))
    other = materialize(other, "positives")
    windows, pairs = [[] for _ in held], []
    for r in other.select("query", "positive_score").distinct().collect():
        p = r.positive_score
        if p >= 0:               # below 0 no score is at least 80 and at most 100 percent
            windows[r.query].append((len(pairs), (-(-low_percent * p // 100), p)))
            pairs.append((len(pairs), r.query, p))
    far = _search(slabs, known | {"windows": windows}, False, negatives)
    kind = slabs.schema["id"].dataType.simpleString()
    pair = spark.createDataFrame(pairs, "query long, anchor long, positive_score long")
    names = spark.createDataFrame([(i, r.id, r.times) for i, r in enumerate(held)],
                                  f"anchor long, anchor_id {kind}, times long")
    return (far.select("query", "rank", F.col("id").alias("negative_id"),
                       F.col("score").alias("negative_score"))
            .join(F.broadcast(pair), "query").drop("query")
            .join(F.broadcast(other.withColumnRenamed("query", "anchor")), ["anchor", "positive_score"])
            .join(F.broadcast(names), "anchor")
            .withColumn("again", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                    "negative_score"))
