"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment
(operator 8).

The items' seeds are n-grams of three neighbouring words, two of them with a
word left out, so that edits between them do no harm.  A seed that many items
hold gives way to longer ones at the same place.  A seed is rare if it stands
in few different passages of the corpus: copies of one passage count once, so
a leak doesn't make its own seeds common.  A stretch of a document is aligned
to an item if it holds a rare seed of it, or so many common ones close to one
diagonal that they cover a good part of the item.

Items are taken in blocks of bounded size, each with two scans of the
documents: one counts passages, one finds and aligns.  Neither shuffles texts.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import (
    materialize, row_key, ship_package, text_or_empty, without_rows,
)
from tessera.llm.words import folded, joined_codes, shaped_grams, text_groups, word_codes

SEED_WORDS = 3           # words of a seed; items with fewer have none
SHAPES = [(0, 1, 2), (0, 1, 3), (0, 2, 3)]
LONGER = [tuple(range(5)), tuple(range(8))]   # where SHAPES are in too many items
MANY_ITEMS = 16          # items that may share a seed before a longer one takes its place
RARE_PASSAGES = 32       # different passages of a rare seed
CONTEXT = 4              # words on either side that tell passages apart
GAP_WORDS = 12           # zeros between the texts of a batch: no seed or passage crosses them
MIN_COVER = 0.25         # of an item's words, in common seeds near one diagonal
LEAST_STEP = 8           # diagonals of a stretch, where the item is shorter
SLACK = 10               # words aligned on either side beside the item's length
MATCH, MISMATCH, GAP = 2, -1, -1
MIN_SCORE = 0.45         # of the score that the whole item would have
FILTER_SHIFT = 42        # a table of 2 ** 22 first bits of the seeds' hashes
BLOCK_WORDS = 500_000    # words of the items that one scan seeks
ALIGN_CELLS = 1 << 15    # cells of one row of a batch of alignments


class Seeds:
    """The seeds of a block of items: for each distinct hash its places."""

    def __init__(self, items: list[np.ndarray]):
        self.items = items
        hashes, owners, places, shapes = [], [], [], []
        for number, codes in enumerate(items):
            for shape, offsets in enumerate(SHAPES + LONGER):
                h = shaped_grams(codes, offsets)
                hashes.append(h)
                owners.append(np.full(len(h), number))
                places.append(np.arange(len(h)))
                shapes.append(np.full(len(h), shape))
        empty = [np.zeros(0, np.int64)]
        h = np.concatenate(hashes + [np.zeros(0, np.uint64)])
        owner, place, shape = (np.concatenate(x + empty) for x in (owners, places, shapes))
        self.sizes = np.array([len(x) for x in items], np.int64)
        keep = self._chosen(h, owner, place, shape, self.sizes)
        order = np.argsort(h[keep], kind="stable")
        h = h[keep][order]
        self.owner, self.place, self.shape = (x[keep][order] for x in (owner, place, shape))
        self.hashes, self.first = np.unique(h, return_index=True)
        self.count = np.diff(np.append(self.first, len(h)))
        self.shapes = [x for s, x in enumerate(SHAPES + LONGER) if (self.shape == s).any()]
        self.maybe = np.zeros(1 << (64 - FILTER_SHIFT), bool)    # before the search by halves
        self.maybe[self.hashes >> np.uint64(FILTER_SHIFT)] = True

    @staticmethod
    def _chosen(h, owner, place, shape, sizes) -> np.ndarray:
        """Seeds that at most ``MANY_ITEMS`` items hold.  At a place whose
        short seeds are in more, the next longer one is taken; the longest that
        the item has is taken in any case, and so is its least shared seed."""
        distinct, at = np.unique(h, return_inverse=True)
        once = np.unique(np.stack([at, owner]), axis=1)
        items = np.bincount(once[0], minlength=len(distinct))[at]
        spot = owner << 32 | place
        keep = (items <= MANY_ITEMS) & (shape < len(SHAPES))
        wanting = (items > MANY_ITEMS) & (shape < len(SHAPES))
        for longer, offsets in enumerate(LONGER, len(SHAPES)):
            room = sizes[owner] - len(offsets)
            keep |= wanting & (room < 0)                     # the item has no longer one
            spots = owner << 32 | np.minimum(place, room)    # near the end, the last one
            asked = (shape == longer) & np.isin(spot, spots[wanting & (room >= 0)])
            keep |= asked & (items <= MANY_ITEMS)
            wanting = asked & (items > MANY_ITEMS)
        keep |= wanting
        order = np.lexsort((items, owner))
        keep[order[np.flatnonzero(np.diff(owner[order], prepend=-1))]] = True
        return keep

    def hits(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(seed, position) of the seeds that stand in a text."""
        found, positions = [], []
        for offsets in self.shapes:
            h = shaped_grams(codes, offsets)
            pos = np.flatnonzero(self.maybe[h >> np.uint64(FILTER_SHIFT)])
            at = np.minimum(np.searchsorted(self.hashes, h[pos]), len(self.hashes) - 1)
            real = self.hashes[at] == h[pos]
            found.append(at[real])
            positions.append(pos[real])
        none = np.zeros(0, np.int64)
        return np.concatenate(found + [none]), np.concatenate(positions + [none])

    def stretches(self, codes: np.ndarray, rare: np.ndarray, hits=None) -> list[tuple[int, int, int]]:
        """(item, start, stop) of the parts of a text to be aligned.  A stretch
        takes the hits on diagonals of twice the item's length."""
        seed, position = self.hits(codes) if hits is None else hits
        if not len(seed):
            return []
        times = self.count[seed]
        flat = np.repeat(self.first[seed] - np.cumsum(times) + times, times) + np.arange(times.sum())
        item, place, shape = self.owner[flat], self.place[flat], self.shape[flat]
        step = np.maximum(self.sizes[item], LEAST_STEP)
        bucket = (np.repeat(position, times) - place) // step
        # a stretch for every bucket with hits, of these and the next bucket's
        near = item << 40 | bucket + (1 << 39)
        groups, own = np.unique(near, return_inverse=True)
        before = np.minimum(np.searchsorted(groups, near - 1), len(groups) - 1)
        also = groups[before] == near - 1
        group = np.concatenate([own, before[also]])
        which = np.concatenate([np.arange(len(near)), np.flatnonzero(also)])
        passed = np.zeros(len(groups), bool)
        passed[group[np.repeat(rare[seed], times)[which]]] = True
        wide = int(self.sizes.max()) + 1
        words = [group[shape[which] == s] * wide + place[which][shape[which] == s] + o
                 for s, offsets in enumerate(SHAPES + LONGER) if offsets in self.shapes for o in offsets]
        covered = np.bincount(np.unique(np.concatenate(words)) // wide, minlength=len(groups))
        passed |= covered >= MIN_COVER * self.sizes[groups >> 40]
        out = []
        for g in groups[passed].tolist():
            i, b = g >> 40, (g & (1 << 40) - 1) - (1 << 39)
            size = int(self.sizes[i])
            step = max(size, LEAST_STEP)
            start, stop = max(0, b * step - SLACK), min(len(codes), (b + 2) * step + size + SLACK)
            if may_align(codes[start:stop], self.items[i]):
                out.append((i, start, stop))
        return out


def align(windows: list[np.ndarray], items: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Smith-Waterman over integer word codes, many pairs at once: best local
    score of each pair and where it ends in the window.

    A row of the matrix is computed for all pairs together; gaps inside a row
    are a running maximum, as each further word costs the same.
    """
    n, wide, long = len(items), max(map(len, items)), max(map(len, windows))
    item = np.full((n, wide), -1, np.int64)
    window = np.full((n, long), -2, np.int64)
    for i, (a, b) in enumerate(zip(items, windows, strict=True)):
        item[i, :len(a)] = a
        window[i, :len(b)] = b
    ramp = np.arange(wide) * -GAP
    above = np.zeros((n, wide + 1), np.int32)
    best, end = np.zeros(n, np.int32), np.zeros(n, np.int32)
    for r in range(long):
        step = np.where(item == window[:, r, None], MATCH, MISMATCH)
        row = np.maximum(np.maximum(above[:, :-1] + step, above[:, 1:] + GAP), 0)
        row = np.maximum.accumulate(row + ramp, axis=1) - ramp
        top = row.max(axis=1)
        end = np.where(top > best, r, end)
        best = np.maximum(best, top)
        above[:, 1:] = row
    return best, end


def may_align(window, item) -> bool:
    """Whether the words that both hold, were they all matched without a
    mismatch or gap, would reach ``MIN_SCORE``: if not, no alignment does."""
    window, item = (x.tolist() if isinstance(x, np.ndarray) else x for x in (window, item))
    return (Counter(window) & Counter(item)).total() / len(item) >= MIN_SCORE


def best_alignments(texts, items: list[np.ndarray],
                    stretches: list[tuple[int, int, int, int]]) -> dict[tuple, tuple]:
    """(text, item) -> (score, first, last word) of the best alignment in the
    (text, item, start, stop) given, where it reaches ``MIN_SCORE``."""
    out: dict[tuple, tuple] = {}
    order = sorted(stretches, key=lambda x: (x[3] - x[2], len(items[x[1]])), reverse=True)
    while order:
        group, wide = [], 1
        while order and (not group or max(wide, len(items[order[-1][1]])) * (len(group) + 1)
                         <= ALIGN_CELLS):
            group.append(order.pop())
            wide = max(wide, len(items[group[-1][1]]))
        windows = [texts[t][a:b].view(np.int64) for t, _, a, b in group]
        wanted = [items[i].view(np.int64) for _, i, _, _ in group]
        best, end = align(windows, wanted)
        hit = [k for k, i in enumerate(wanted) if best[k] / (MATCH * len(i)) >= MIN_SCORE]
        if not hit:
            continue
        # where it starts: the same from its end backwards
        _, back = align([windows[k][end[k]::-1] for k in hit], [wanted[k][::-1] for k in hit])
        for k, e in zip(hit, back.tolist(), strict=True):
            t, i, start, _ = group[k]
            last = start + int(end[k])
            found = (int(best[k]) / (MATCH * len(wanted[k])), -(last - e), -last)
            out[t, i] = max(out.get((t, i), found), found)
    return {key: (s, -a, -b) for key, (s, a, b) in out.items()}


def _passages(docs: DataFrame, seeds: Seeds) -> np.ndarray:
    """Whether each seed is rare.  Of a batch's passages only as many are
    handed on as decide that."""
    sent = docs.sparkSession.sparkContext.broadcast(seeds)

    def run(batches):
        known = sent.value
        for b in batches:
            pairs = [np.zeros((2, 0), np.int64)]
            for _, texts in text_groups(b.column(3)):
                codes, _, _ = joined_codes(list(map(folded, texts)), GAP_WORDS)
                seed, position = known.hits(codes)
                around = np.zeros(len(position), np.uint64)
                for i in range(-CONTEXT, SEED_WORDS + CONTEXT):
                    around = (around ^ codes[position + i]) * np.uint64(0x9E3779B97F4A7C15)
                    around ^= around >> np.uint64(31)
                pairs.append(np.stack([seed, around.view(np.int64)]))
            pairs = np.unique(np.concatenate(pairs, axis=1), axis=1)
            start = np.searchsorted(pairs[0], pairs[0])
            pairs = pairs[:, np.arange(pairs.shape[1]) - start <= RARE_PASSAGES]
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])],
                                             names=["seed", "passage"])

    counted = (docs.mapInArrow(run, "seed long, passage long").distinct()
               .groupBy("seed").agg(F.count("*").alias("n")).where(F.col("n") > RARE_PASSAGES))
    rare = np.ones(len(seeds.hashes), bool)
    rare[[r.seed for r in counted.collect()]] = False      # at most one row a seed of the block
    return rare


def _found(docs: DataFrame, seeds: Seeds, rare: np.ndarray) -> DataFrame:
    """(id, k1, k2, item, score, first_word, last_word), by item number."""
    sent = docs.sparkSession.sparkContext.broadcast((seeds, rare))

    def run(batches):
        known, sure = sent.value
        for b in batches:
            texts, stretches = {}, []
            for first, group in text_groups(b.column(3)):
                codes, places, sizes = joined_codes(list(map(folded, group)), GAP_WORDS)
                seed, position = known.hits(codes)
                owner = np.searchsorted(places, position, side="right") - 1
                order = np.argsort(owner, kind="stable")
                cuts = np.flatnonzero(np.diff(owner[order], prepend=-1))
                for hits in np.split(order, cuts[1:]) if len(order) else ():
                    i = int(owner[hits[0]])
                    text = codes[places[i]:places[i] + sizes[i]]
                    new = known.stretches(text, sure, (seed[hits], position[hits] - places[i]))
                    if new:
                        texts[first + i] = text
                        stretches += [(first + i, *x) for x in new]
            best = best_alignments(texts, known.items, stretches)
            at = pa.array([t for t, _ in best], pa.int64())
            score, first, last = zip(*best.values(), strict=True) if best else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c).take(at) for c in range(3)],
                 pa.array([i for _, i in best], pa.int32()), pa.array(score, pa.float64()),
                 pa.array(first, pa.int64()), pa.array(last, pa.int64())],
                names=["id", "k1", "k2", "item", "score", "first_word", "last_word"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, k1 long, k2 long, item int, score double, "
                                "first_word long, last_word long")


def contaminated(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                 text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text") -> DataFrame:
    """One row per document and benchmark item found in it: ``id``, ``k1``,
    ``k2`` (row key), ``item_id``, ``score`` (share of the item's full
    alignment score, at least ``MIN_SCORE``), ``first_word`` and ``last_word``
    of the best place (words from 0).

    Words are runs of letters, digits and non-ASCII characters, A-Z
    lower-cased.  Items of fewer than ``SEED_WORDS`` words (null text
    included) cannot be seeded and are never found; equal items under several
    ids are found under each.  Null texts hold nothing; null ids pass through;
    exact repetitions of a row give one result; either table may be empty.
    """
    spark = df.sparkSession
    ship_package(spark)
    id_, text, item, item_text = (F.col(f"`{c}`") for c in (id_col, text_col, item_col, item_text_col))
    asked = materialize(benchmark.select(
        item.alias("item_id"), text_or_empty(item_text).cast("binary").alias("text")).distinct(),
        "benchmark-items")
    words = F.octet_length("text") / 4 + 1
    size = asked.agg(F.coalesce(F.sum(words), F.lit(0))).first()[0]
    blocks = max(1, int(-(-size // BLOCK_WORDS)))
    t = text_or_empty(text)
    k1, k2 = row_key(id_, t)
    docs = df.select(id_.alias("id"), k1, k2, t.cast("binary").alias("text"))
    kind = asked.schema["item_id"].dataType.simpleString()
    out = None
    for block in range(blocks):
        held = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        coded = [(r.item_id, word_codes(folded(bytes(r.text)))) for r in held]
        coded = [(i, c) for i, c in coded if len(c) >= SEED_WORDS]
        seeds = Seeds([c for _, c in coded])
        found = _found(docs, seeds, _passages(docs, seeds))
        names = spark.createDataFrame([(n, i) for n, (i, _) in enumerate(coded)],
                                      f"item int, item_id {kind}")
        found = materialize(found.join(F.broadcast(names), "item").drop("item"), "contaminated")
        out = found if out is None else out.unionByName(found)
    # rows repeat only where the input's do, or where a benchmark's folded texts are equal
    return out.select("id", "k1", "k2", "item_id", "score", "first_word", "last_word").distinct()


def without_contaminated(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                         text_col: str = "text") -> DataFrame:
    """The input without the documents that hold a benchmark item."""
    gone = materialize(contaminated(df, benchmark, id_col, text_col).select("k1", "k2")
                       .distinct(), "contaminated-keys")
    return without_rows(df, row_key(f"`{id_col}`", text_or_empty(f"`{text_col}`")), gone)
