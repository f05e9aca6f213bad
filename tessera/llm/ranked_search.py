"""Ranked lexical search over K2-treaps (operator 11).

Queries are taken in bounded blocks.  A pass over the documents leaves, for
each, its length and its counts of the block's terms; corpus counts come from
these by grouped aggregation.  Every batch of documents is a range of its own:
a compressed quadtree over the grid of terms and documents whose cells hold
the largest impact below them.  The paths of a query's term rows descend
together, best range first, and ranges whose summed maxima are below the k-th
score found so far are left.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import fresh_name, materialize, ship_package, text_or_empty
from tessera.llm.words import folded
from tessera.operators.joins import measure

SATURATION, LENGTH_PERCENT = 8, 90
QUERIES_PER_BLOCK = 4_096
QUERY_BYTES = 8 * 2 ** 20      # of one block's texts
RANGES_AT_ONCE = 256           # ranges that one step of a descent opens


def terms_of(text: bytes) -> list[bytes]:
    return folded(text).split()


class Treap:
    """Compressed quadtree over (row, column, impact); cell 0 is empty."""

    def __init__(self, rows: np.ndarray, columns: np.ndarray, impacts: np.ndarray):
        side = int(max(rows.max(initial=0), columns.max(initial=0))) + 1
        self.height = max(1, (side - 1).bit_length())
        code = np.zeros(len(rows), np.int64)
        for bit in range(self.height):
            code |= ((rows >> bit & 1) << 2 * bit + 1) | ((columns >> bit & 1) << 2 * bit)
        order = np.argsort(code)
        code, top = code[order], impacts[order].astype(np.int64)
        # levels from the points up to the root, each after the one before
        base, maxima, children = 1, [np.zeros(1, np.int64), top], [np.zeros((1 + len(code), 4), np.int32)]
        for _ in range(self.height):
            parent = code >> 2
            first = np.flatnonzero(np.diff(parent, prepend=-1))
            owner = np.cumsum(np.diff(parent, prepend=-1) != 0) - 1
            below = np.zeros((len(first), 4), np.int32)
            below[owner, code & 3] = base + np.arange(len(code))
            base += len(code)
            code = parent[first]
            top = np.maximum.reduceat(top, first) if len(first) else top
            maxima.append(top)
            children.append(below)
        self.maxima, self.children = np.concatenate(maxima), np.concatenate(children)
        self.root = len(self.maxima) - 1 if len(rows) else 0

    def best(self, rows: np.ndarray, k: int, least: int) -> list[tuple[int, int]]:
        """(score, column) of the ``k`` columns with the highest sums over
        ``rows``, those above 0 and not below ``least``; equal sums by column."""
        rows = rows[rows < 1 << self.height]           # the others have no point here
        way = rows[None, :] >> np.arange(self.height)[:, None] & 1        # by level
        bound = np.array([self.maxima[self.root] * len(rows)])
        level, column = np.array([self.height]), np.array([0])
        cells = np.full((1, len(rows)), self.root, np.int32)
        scores, places = np.zeros(0, np.int64), np.zeros(0, np.int64)
        least = max(least, 1)
        while True:
            live = np.flatnonzero(bound >= least)
            if not len(live):
                break
            if len(live) > RANGES_AT_ONCE:
                cut = np.argpartition(-bound[live], RANGES_AT_ONCE)
                now, later = live[cut[:RANGES_AT_ONCE]], live[cut[RANGES_AT_ONCE:]]
            else:
                now, later = live, live[:0]
            step = level[now] - 1
            child = 2 * way[step]
            halves = [self.children[cells[now], child + right] for right in (0, 1)]
            new_cells = np.concatenate(halves)
            new_column = np.concatenate([2 * column[now], 2 * column[now] + 1])
            new_bound = self.maxima[new_cells].sum(axis=1)
            new_level = np.concatenate([step, step])
            done = (new_level == 0) & (new_bound >= least)
            if done.any():
                scores = np.concatenate([scores, new_bound[done]])
                places = np.concatenate([places, new_column[done]])
                top = np.lexsort((places, -scores))[:k]
                scores, places = scores[top], places[top]
                if len(scores) == k:
                    least = max(least, int(scores[-1]))
            stay = (new_level > 0) & (new_bound >= least)
            bound = np.concatenate([bound[later], new_bound[stay]])
            level = np.concatenate([level[later], new_level[stay]])
            column = np.concatenate([column[later], new_column[stay]])
            cells = np.concatenate([cells[later], new_cells[stay]])
        return list(zip(scores.tolist(), places.tolist(), strict=True))


def _postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc, n, terms, counts) of every document; terms of the block only."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        known = sent.value
        for b in batches:
            sizes, ends, terms, counts = [], [0], [], []
            for t in b.column(1):
                words = terms_of(t.as_py())
                sizes.append(len(words))
                held = Counter(map(known.get, words))
                held.pop(None, None)
                terms += held.keys()
                counts += held.values()
                ends.append(len(terms))
            ends = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(sizes, pa.int64()),
                 pa.ListArray.from_arrays(ends, pa.array(terms, pa.int32())),
                 pa.ListArray.from_arrays(ends, pa.array(counts, pa.int64()))],
                names=["doc", "n", "terms", "counts"])

    kind = docs.schema["doc"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc {kind}, n long, terms array<int>, counts array<long>")


def _best(postings: DataFrame, queries: list[list[int]], weights: list[int], total: int,
          length: int, k: int) -> DataFrame:
    """(query, doc, score): each task's ``k`` best documents for each query."""
    sent = postings.sparkSession.sparkContext.broadcast((queries, weights))

    def run(batches):
        rows, weight = [np.array(q, np.int64) for q in sent.value[0]], np.array(sent.value[1], np.int64)
        found: list[list[tuple]] = [[] for _ in rows]
        kind = pa.int64()
        for b in batches:
            kind = b.column(0).type
            if not b.num_rows:
                continue
            b = b.take(pc.sort_indices(b.column(0)))          # nulls last
            ids = b.column(0).to_pylist()
            m = np.array([100 - LENGTH_PERCENT + LENGTH_PERCENT * n * total // max(length, 1)
                          for n in b.column(1).to_pylist()], np.int64)
            lists = b.column(2)
            sizes = np.diff(lists.offsets.to_numpy())
            columns = np.repeat(np.arange(b.num_rows), sizes)
            terms = lists.flatten().to_numpy().astype(np.int64)
            tf = b.column(3).flatten().to_numpy()
            impact = weight[terms] * (1_000_000_000 * tf // (1000 * tf + SATURATION * m[columns]))
            grid = Treap(terms, columns, impact)
            for q, r in enumerate(rows):
                least = found[q][-1][0] if len(found[q]) == k else 0
                new = grid.best(r, k, least)
                if new:
                    both = found[q] + [(s, ids[c]) for s, c in new]
                    both.sort(key=lambda x: (-x[0], x[1] is None, x[1]))
                    found[q] = both[:k]
        out = [(q, d, s) for q, x in enumerate(found) for s, d in x]
        if out:
            q, d, s = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(q, pa.int32()), pa.array(d, kind), pa.array(s, pa.int64())],
                names=["query", "doc", "score"])

    kind = postings.schema["doc"].dataType.simpleString()
    return postings.mapInArrow(run, f"query int, doc {kind}, score long")


def _named(name: str, df: DataFrame) -> Column:
    return df[f"`{name}`"]


def rank(df: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "doc_id",
         text_col: str = "text", query_col: str = "item_id",
         query_text_col: str = "text") -> DataFrame:
    """The ``k`` best documents for each query: the query's id, ``rank`` (from
    1), the document's id and ``score``; scores of 0 are left out.

    Terms are runs of ASCII letters, digits and non-ASCII characters, A-Z
    lower-cased.  Equal scores go by ascending document id, nulls last.  Null
    texts have no terms; a query without terms has no result.  Equal query
    rows count once; rows that share an id but not the text are ranked each
    for itself, under that id.  Repeated documents rank each.  Either table
    may be empty.  Other columns are not read.
    """
    spark = df.sparkSession
    ship_package(spark)
    docs = df.select(_named(id_col, df).alias("doc"),
                     text_or_empty(_named(text_col, df)).cast("binary").alias("text"))
    asked = materialize(queries.select(
        _named(query_col, queries).alias("qid"),
        text_or_empty(_named(query_text_col, queries)).cast("binary").alias("text")).distinct(),
        "ranked-queries")
    n, size = measure(asked)
    blocks = max(1, -(-n // QUERIES_PER_BLOCK), -(-size // QUERY_BYTES))
    qtype = asked.schema["qid"].dataType
    out = None
    for block in range(blocks):
        # bounded by the two parameters above
        held = asked.where(F.pmod(F.xxhash64("qid", "text"), F.lit(blocks)) == block).collect()
        words = [sorted(set(terms_of(bytes(r.text)))) for r in held]
        vocabulary = {w: i for i, w in enumerate(sorted(set().union(*words)))}
        postings = materialize(_postings(docs, vocabulary), "postings")
        total, length = postings.agg(F.count(F.when(F.col("n") > 0, 1)),
                                     F.coalesce(F.sum("n"), F.lit(0))).first()
        df_of = dict(postings.select(F.explode("terms").alias("t")).groupBy("t").count().collect())
        weights = [math.floor(1000 * math.log((2 * total + 2) / (2 * df_of.get(i, 0) + 1)))
                   for i in range(len(vocabulary))]
        found = _best(postings, [[vocabulary[w] for w in ws] for ws in words], weights, total,
                      length, k)
        order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
        names = spark.createDataFrame([(i, r.qid) for i, r in enumerate(held)],
                                      f"query int, qid {qtype.simpleString()}")
        top = (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
               .join(F.broadcast(names), "query").select("qid", "rank", "doc", "score"))
        if blocks > 1:
            top = materialize(top, "ranked-block")
        out = top if out is None else out.union(top)
    names = {"qid": query_col, "doc": fresh_name(queries.select(_named(query_col, queries)), id_col)}
    return out.select(*[F.col(c).alias(names.get(c, c)) for c in out.columns])
