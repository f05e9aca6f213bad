"""Substring dedup by relative Lempel-Ziv parsing (operator 12).

Every window of ``WINDOW`` words has a seed, the least hash of its
``SEED_WORDS``-grams, so equal windows have equal seeds.  The smallest document
that holds a seed is the seed's home; a home's passages around its seeds are
one reference block.  The other documents' passages travel to the homes of
their seeds and are factored greedily against the block's suffix array;
factors of at least a window's length are duplicate spans.  Windows that lie in
no such factor may still stand in a document between the home and their own:
these are compared by the hash of the whole window.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import (
    attach, broadcast_if_bounded, materialize, settled, ship_package, text_or_empty,
)
from tessera.llm.words import grams, joined_codes, text_groups, word_codes
from tessera.operators.joins import HOT_ROWS, skew_join

WINDOW = 13
SEED_WORDS = 6
PIECES_PER_TASK = 500     # passages that one task factors against one block
PROBE = 4                 # words; a window whose runs of so many aren't all in the block isn't either
ROWS_OUT = 1 << 18        # rows of a batch that a task hands on


def window_seeds(codes: np.ndarray) -> np.ndarray:
    """The seed of each window, as signed numbers."""
    places = max(0, len(codes) - WINDOW + 1)
    h = grams(codes, SEED_WORDS)
    if not places:
        return np.zeros(0, np.int64)
    return np.minimum.reduce([h[i:i + places] for i in range(WINDOW - SEED_WORDS + 1)]).view(np.int64)


class Block:
    """Reference passages under one suffix array."""

    def __init__(self, passages: list[np.ndarray]):
        gap = np.zeros(1, np.uint64)                     # no word has code 0
        self.codes = np.concatenate([x for p in passages for x in (p, gap)])
        self.probes = np.unique(grams(self.codes, PROBE))
        self.order = self.first = None                   # sorted when first asked

    def _sort(self) -> None:
        n = len(self.codes)
        rank = np.unique(self.codes, return_inverse=True)[1].astype(np.int64)
        step, order = 1, np.argsort(rank, kind="stable")
        while rank.max() < n - 1:
            after = np.zeros(n, np.int64)
            after[:n - step] = rank[step:] + 1
            key = rank * (n + 1) + after
            order = np.argsort(key, kind="stable")
            new = np.empty(n, np.int64)
            new[order] = np.cumsum(np.diff(key[order], prepend=key[order[0]]) != 0)
            rank, step = new, 2 * step
        self.order, self.first = order, self.codes[order]

    def runs(self, probes: np.ndarray) -> list[tuple[int, int]]:
        """[start, stop) of the longest runs of at least a window's words
        whose ``PROBE``-grams all stand in the block; ``probes``: the
        ``PROBE``-grams of the words."""
        if not len(self.probes):
            return []
        near = np.minimum(np.searchsorted(self.probes, probes), len(self.probes) - 1)
        inside = self.probes[near] == probes
        if inside.all():
            return [(0, len(probes) + PROBE - 1)] if len(probes) > WINDOW - PROBE else []
        edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        return [(s, e + PROBE - 1) for s, e in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)
                if e - s >= WINDOW - PROBE + 1]

    def longest(self, words: np.ndarray, at: int) -> int:
        """Words from ``at`` on that stand together somewhere in the block."""
        if self.order is None:
            self._sort()
        lo, hi, depth, column = 0, len(self.order), 0, self.first
        while at + depth < len(words):
            w = words[at + depth]
            left, right = np.searchsorted(column, w), np.searchsorted(column, w, side="right")
            if left == right:
                return depth
            lo, hi, depth = lo + int(left), lo + int(right), depth + 1
            if hi - lo == 1:
                there = self.codes[self.order[lo] + depth:]
                here = words[at + depth:at + depth + len(there)]
                differ = np.flatnonzero(here != there[:len(here)])
                return depth + int(differ[0] if len(differ) else len(here))
            column = self.codes[self.order[lo:hi] + depth]
        return depth


def factors(words: np.ndarray, block: Block, probes: np.ndarray) -> list[tuple[int, int]]:
    """[start, stop) of the greedy factors that hold a window.  The next
    factor starts where the first window over the last one's boundary does, so
    windows that cross a boundary are tried too."""
    spans = []
    for at, stop in block.runs(probes):
        while at + WINDOW <= stop:
            size = block.longest(words, at)
            if size >= WINDOW:
                spans.append((at, at + size))
                at += size - WINDOW + 1
            else:
                at += 1
    return spans


def _seeds(docs: DataFrame) -> DataFrame:
    """(h, doc, row): the distinct seeds of every document."""
    def run(batches):
        for b in batches:
            parts, rows, waiting = [], [], 0

            def block(b=b):
                take = pa.array(np.concatenate(rows))
                return pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(parts)), b.column(0).take(take), b.column(1).take(take)],
                    names=["h", "doc", "row"])
            for first, texts in text_groups(b.column(2)):
                codes, places, sizes = joined_codes(texts, WINDOW)
                all_seeds = window_seeds(codes)
                for i, (at, size) in enumerate(zip(places.tolist(), sizes.tolist(), strict=True)):
                    parts.append(np.unique(all_seeds[at:at + max(0, size - WINDOW + 1)]))
                    rows.append(np.full(len(parts[-1]), first + i))
                    waiting += len(parts[-1])
                    if waiting >= ROWS_OUT:
                        yield block()
                        parts, rows, waiting = [], [], 0
            if waiting:
                yield block()

    kind = docs.schema["doc"].dataType.simpleString()
    return docs.mapInArrow(run, f"h long, doc {kind}, row long")


def _homes(rows: DataFrame, key: str, name: str) -> DataFrame:
    """``rows`` whose ``key`` stands in documents of several ids, with the
    smallest such id as ``home``.  The table of homes grows with the corpus,
    so the join is shuffled at any size; hot keys are salted."""
    shared = materialize(rows.groupBy(key).agg(
        F.min("doc").alias("home"), F.max("doc").alias("last"), F.count("*").alias("n"))
        .where("home < last").select(key, "home", "n"), name)
    hot = shared.where(F.col("n") > HOT_ROWS).select(
        key, F.ceil(F.col("n") / HOT_ROWS).cast("int").alias("__salts"))
    return skew_join(rows, shared.select(key, "home"), key, "inner", hot=hot)


def _pieces(docs: DataFrame, seeds: DataFrame, load: DataFrame) -> DataFrame:
    """(home, guest, doc, row, start, codes): the longest runs of windows
    whose seeds have one home; ``guest`` is 0 for the home's own."""
    lists = materialize(seeds.groupBy("doc", "row").agg(
        F.collect_set(F.struct("h", "home")).alias("seeds")), "substring-seeds")
    texts = attach(docs, lists, ["doc", "row"], load, "inner").select("doc", "row", "text", "seeds")
    kind = docs.schema["doc"].dataType.simpleString()

    def run(batches):
        for b in batches:
            out, waiting = [], 0

            def block():
                return pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)],
                    names=["home", "guest", "doc", "row", "start", "codes"])
            id_type = b.column(0).type
            types = [id_type, pa.int32(), id_type, pa.int64(), pa.int32(), pa.binary()]
            for i in range(b.num_rows):
                doc, row = b.column(0)[i].as_py(), b.column(1)[i].as_py()
                pairs = b.column(3)[i].values
                h = pairs.field("h").to_numpy()
                home = pairs.field("home").dictionary_encode()
                names, home = home.dictionary.to_pylist(), home.indices.to_numpy()
                sort = np.argsort(h)
                h, home = h[sort], home[sort]
                codes = word_codes(b.column(2)[i].as_py())
                mine = window_seeds(codes)
                at = np.minimum(np.searchsorted(h, mine), len(h) - 1)
                to = np.where(h[at] == mine, home[at], -1)
                cuts = np.flatnonzero(np.diff(to, prepend=-2, append=-2))
                for s, e in zip(cuts[:-1], cuts[1:], strict=True):
                    if to[s] >= 0:
                        name = names[to[s]]
                        piece = codes[s:e + WINDOW - 1].tobytes()
                        out.append((name, int(name != doc), doc, row, s, piece))
                        waiting += len(piece) + 64
                if waiting >= ROWS_OUT * 16:
                    yield block()
                    out, waiting = [], 0
            if out:
                yield block()

    return texts.mapInArrow(
        run, f"home {kind}, guest int, doc {kind}, row long, start int, codes binary")


def _factored(pieces: DataFrame) -> DataFrame:
    """(doc, row, start, stop, w): duplicate spans of the pieces (``w`` null),
    and the windows in no span with their hash ``w``.  A home with many pieces
    is spread over several tasks, each with the home's block."""
    load = pieces.where("guest = 1").groupBy("home").agg(F.count("*").alias("n"))
    hot = materialize(load.where(F.col("n") > PIECES_PER_TASK).select(
        "home", F.ceil(F.col("n") / PIECES_PER_TASK).cast("int").alias("salts")), "hot-homes")
    small = broadcast_if_bounded(hot)
    salts = F.coalesce("salts", F.lit(1))
    dealt = pieces.join(hot if small is None else small, "home", "left").withColumn(
        "salt", F.explode(F.when(F.col("guest") == 0, F.sequence(F.lit(0), salts - 1)).otherwise(
            F.array(F.pmod(F.xxhash64("doc", "row", "start"), salts).cast("int"))))).drop("salts")
    kind = pieces.schema["doc"].dataType.simpleString()

    def run(batches):
        key, passages, block = None, [], None
        for b in batches:
            at, starts, stops, windows = [], [], [], []
            home, guest, start, data, salt = (b.column(i).to_pylist() for i in (0, 1, 4, 5, 6))
            # hashes of all pieces together; those over a piece's end are not looked at
            codes = np.frombuffer(b"".join(data), np.uint64)
            probes, hashes = grams(codes, PROBE), grams(codes, WINDOW).view(np.int64)
            ends = np.cumsum([0, *map(len, data)]) // 8
            for i in range(b.num_rows):
                if key != (home[i], salt[i]):
                    key, passages, block = (home[i], salt[i]), [], None
                here, to = int(ends[i]), int(ends[i + 1])
                words = codes[here:to]
                if not guest[i]:
                    passages.append(words)
                    continue
                if block is None:
                    block = Block(passages)
                open_ = np.ones(len(words) - WINDOW + 1, bool)
                for s, e in factors(words, block, probes[here:to - PROBE + 1]):
                    open_[s:e - WINDOW + 1] = False
                    at.append([i])
                    starts.append([start[i] + s])
                    stops.append([start[i] + e])
                    windows.append([0])
                left = np.flatnonzero(open_)
                if len(left):
                    at.append(np.full(len(left), i))
                    starts.append(left + start[i])
                    stops.append(np.full(len(left), -1))
                    windows.append(hashes[here:to - WINDOW + 1][left])
            if at:
                at, starts, stops, windows = (np.concatenate(x) for x in (at, starts, stops, windows))
                sure = stops >= 0
                stops = np.where(sure, stops, starts + WINDOW)
                yield pa.RecordBatch.from_arrays(
                    [b.column(2).take(pa.array(at)), b.column(3).take(pa.array(at)),
                     pa.array(starts, pa.int32()), pa.array(stops, pa.int32()),
                     pa.array(windows, pa.int64(), mask=sure)],
                    names=["doc", "row", "start", "stop", "w"])

    return (dealt.select("home", "guest", "doc", "row", "start", "codes", "salt")
            .repartition("home", "salt").sortWithinPartitions("home", "salt", "guest")
            .mapInArrow(run, f"doc {kind}, row long, start int, stop int, w long"))


def _keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    t = text_or_empty(df[f"`{text_col}`"])
    return df.select(df[f"`{id_col}`"].alias("doc"), F.xxhash64(t).alias("row"),
                     t.cast("binary").alias("text"))


def duplicate_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, row, spans), written: for each document with a repeated passage,
    the spans of words [start, stop) that windows of ``WINDOW`` words cover
    whose sequence also starts in a document with a smaller id.  ``row`` is
    xxhash64 of the text: rows that share an id are told apart by it."""
    spark = df.sparkSession
    ship_package(spark)
    return settled(spark, lambda: _spans(df, id_col, text_col), "substring-spans")


def _spans(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    docs = _keyed(df, id_col, text_col)
    load = docs.groupBy("doc", "row").agg(F.count("*").alias("n"))
    named = docs.where("doc is not null")
    seeds = _homes(_seeds(named), "h", "shared-seeds")
    found = materialize(_factored(materialize(_pieces(named, seeds, load), "substring-pieces")),
                        "substring-factors")
    rest = found.where("w is not null")
    late = _homes(rest, "w", "shared-windows").where("doc > home")
    spans = found.where("w is null").select("doc", "row", "start", "stop").union(
        late.select("doc", "row", "start", "stop"))
    return spans.groupBy("doc", "row").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))


def without_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id, ``n_words``, ``n_removed`` and ``kept``,
    the words that stay, joined by one space.

    Words stand between ASCII white space.  A word goes if a window of
    ``WINDOW`` words covers it whose sequence also starts in a document with a
    smaller id; windows are judged on the input.  Null texts have no words;
    texts shorter than a window lose none.  Rows with a null id lose nothing
    and no row loses words to them; rows with equal ids don't affect each
    other; repeated rows are treated alike.  Other columns are not read.
    """
    docs = _keyed(df, id_col, text_col)
    load = docs.groupBy("doc", "row").agg(F.count("*").alias("n"))
    spans = duplicate_spans(df, id_col, text_col)
    judged = attach(docs, spans, ["doc", "row"], load).select("doc", "text", "spans")

    def run(batches):
        for b in batches:
            totals, gone, kept = [], [], []
            for text, places in zip(b.column(1), b.column(2), strict=True):
                words = text.as_py().split()
                totals.append(len(words))
                if places.is_valid:
                    edge = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edge, places.values.field("start").to_numpy(), 1)
                    np.add.at(edge, places.values.field("stop").to_numpy(), -1)
                    stay = np.cumsum(edge[:-1]) == 0
                    words = [words[i] for i in np.flatnonzero(stay)]
                gone.append(totals[-1] - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(totals, pa.int64()), pa.array(gone, pa.int64()),
                 pa.array(kept, pa.binary())], names=["doc", "n_words", "n_removed", "kept"])

    kind = docs.schema["doc"].dataType.simpleString()
    return (judged.mapInArrow(run, f"doc {kind}, n_words long, n_removed long, kept binary")
            .select(F.col("doc").alias(id_col), "n_words", "n_removed",
                    F.col("kept").cast("string").alias("kept")))
