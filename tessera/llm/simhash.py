"""SimHash near-dedup by meet-in-the-middle ball hashing (operator 5).

Every distinct fingerprint emits all variants within half the radius; two
fingerprints within the radius share a variant.  The members of one variant
are within the radius of each other, so linking each to the smallest member
keeps every component without emitting all pairs.
"""

from __future__ import annotations

from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tessera.llm.common import (
    attach, materialize, row_key, ship_package, text_or_empty, without_rows,
)

BITS = 64
SEED = 42
BLOCK = 1 << 15           # shingles counted at a time


def fingerprint(text: bytes, shingle_words: int) -> int:
    """Signed 64-bit SimHash of UTF-8 text: A-Z lower-cased, words between
    ASCII white space, shingles with repeats; a bit is set if it is in over
    half of the shingles' XXH64.  Fewer words: one shingle of all; none: 0."""
    words = text.lower().split()
    if not words:
        return 0
    size = min(shingle_words, len(words))
    digest = partial(xxhash.xxh64_digest, seed=SEED)
    total = len(words) - size + 1
    counts = np.zeros(BITS, np.int64)
    for at in range(0, total, BLOCK):
        block = words[at:at + BLOCK + size - 1]
        hashes = b"".join(map(digest, map(b" ".join, zip(*(block[i:] for i in range(size)),
                                                         strict=False))))
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > total).tobytes(), "big", signed=True)


def fingerprints(df: DataFrame, shingle_words: int = 3, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``id``, ``k1``, ``k2`` (row key) and ``fp`` of every row."""
    ship_package(df.sparkSession)
    src = df.select(F.col(id_col).alias("id"), *row_key(id_col, text_or_empty(text_col)),
                    text_or_empty(text_col).cast("binary").alias("text"))

    def run(batches):
        for b in batches:
            fp = [fingerprint(t.as_py(), shingle_words) for t in b.column(3)]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:3], pa.array(fp, pa.int64())], names=["id", "k1", "k2", "fp"])

    return src.mapInArrow(run, StructType([*src.schema[:3], StructField("fp", LongType())]))


def ball(fp: Column, radius: int) -> Column:
    """Array of the fingerprints that differ from ``fp`` in at most ``radius`` bits."""
    masks = [sum(1 << b for b in bits)
             for r in range(radius + 1) for bits in combinations(range(BITS), r)]
    signed = [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]
    return F.array(*[fp.bitwiseXOR(F.lit(m).cast("long")) for m in signed])


def links(distinct: DataFrame, max_bits: int) -> DataFrame:
    """(child, parent), parent < child: verified links that connect exactly
    the fingerprints whose distances chain up within ``max_bits``."""
    if max_bits % 2 or not 0 <= max_bits <= 4:
        raise ValueError("the maximum bit distance is 0, 2 or 4")
    met = Window.partitionBy("variant")       # at most 65 members for radius 1
    return (distinct.select("fp", F.explode(ball(F.col("fp"), max_bits // 2)).alias("variant"))
            .select(F.col("fp").alias("child"), F.min("fp").over(met).alias("parent"))
            .where((F.col("parent") < F.col("child"))
                   & (F.bit_count(F.col("child").bitwiseXOR(F.col("parent"))) <= max_bits))
            .distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("child", "parent"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(child, parent): every node of ``edges`` but the smallest of its
    component, with that smallest one.  Alternates large-star and small-star
    steps; each round is written, so a lost executor costs one round."""
    edges = materialize(edges, "links")
    state, before = _state(edges), None
    while state != before:
        before = state
        least = materialize(edges.groupBy("child").agg(F.min("parent").alias("least")), "least")
        load = edges.groupBy("parent").agg(F.count("*").alias("n"))
        up = (attach(edges, least.withColumnRenamed("child", "parent"), "parent", load)
              .select("child", F.coalesce("least", "parent").alias("parent")).distinct())
        up = materialize(up, "large-star")
        least = materialize(up.groupBy("child").agg(F.min("parent").alias("least")), "least")
        load = up.groupBy("child").agg(F.count("*").alias("n"))
        moved = (attach(up, least, "child", load).where("parent != least")
                 .select(F.col("parent").alias("child"), F.col("least").alias("parent")))
        edges = materialize(moved.union(least).distinct(), "small-star")
        state = _state(edges)
    return edges


def grouped(df: DataFrame, shingle_words: int = 3, max_bits: int = 2, id_col: str = "doc_id",
            text_col: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, groups, counts): ``rows`` = id, k1, k2, fp of every row;
    ``groups`` = fp, root, component_id of the fingerprints that several rows
    share or that are linked; ``counts`` = fp, n."""
    rows = materialize(fingerprints(df, shingle_words, id_col, text_col), "fingerprints")
    counts = materialize(rows.groupBy("fp").agg(F.min("id").alias("least_id"),
                                                F.count("*").alias("n")), "fingerprint-counts")
    roots = components(links(counts.select("fp"), max_bits))
    ends = materialize(roots.union(roots.select("parent", "parent")).distinct()
                       .toDF("fp", "root"), "roots")
    several = counts.join(ends, "fp", "left").where("root is not null or n > 1").select(
        "fp", F.coalesce("root", "fp").alias("root"), "least_id", "n")
    several = materialize(several, "shared-fingerprints")
    ids = materialize(several.groupBy("root").agg(
        F.min("least_id").alias("component_id")), "component-ids")
    load = several.groupBy("root").agg(F.count("*").alias("n"))
    groups = materialize(attach(several.select("fp", "root"), ids, "root", load)
                         .select("fp", "root", "component_id"), "groups")
    return rows, groups, counts


def near_duplicates(df: DataFrame, shingle_words: int = 3, max_bits: int = 2,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id, ``fingerprint`` (16 hex digits) and
    ``component_id``, the smallest id reachable over links of at most
    ``max_bits`` differing bits (0, 2 or 4).

    Null text counts as empty; texts without words have fingerprint zero and
    link like any other.  Null ids pass through and take part, but name a
    component only if it has no other id (then ``component_id`` is null).
    Repeated rows each get their row.  Other columns are not read.
    """
    rows, groups, counts = grouped(df, shingle_words, max_bits, id_col, text_col)
    named = attach(rows, groups, "fp", counts)
    return named.select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("component_id"))
        .alias("component_id"))


def keep_one(df: DataFrame, shingle_words: int = 3, max_bits: int = 2, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """The input with one row of each component: that with the smallest id
    (among equal or only null ids, the one with the smallest row key; of rows
    equal in id and text, any one)."""
    rows, groups, counts = grouped(df, shingle_words, max_bits, id_col, text_col)
    shared = materialize(attach(rows, groups, "fp", counts, "inner"), "shared-rows")
    load = shared.groupBy("root").agg(F.count("*").alias("n"))
    firsts = shared.where(F.col("id").eqNullSafe(F.col("component_id")))
    stays = materialize(firsts.groupBy("root").agg(
        F.min(F.struct("k1", "k2")).alias("stay")), "representatives")
    judged = attach(shared.select("root", "k1", "k2"), stays, "root", load)
    gone = materialize(judged.where("k1 != stay.k1 or k2 != stay.k2")
                       .select("k1", "k2").distinct(), "near-copies")
    again = materialize(judged.where("k1 = stay.k1 and k2 = stay.k2").groupBy("k1", "k2")
                        .agg(F.count("*").alias("n")).where("n > 1").select("k1", "k2"),
                        "repeated-rows")
    key = row_key(id_col, text_or_empty(text_col))
    left = without_rows(df, key, gone)
    if again.isEmpty():
        return left
    once = (df.withColumns({"__k1": key[0], "__k2": key[1]})
            .join(again.toDF("__k1", "__k2"), ["__k1", "__k2"], "left_semi")
            .dropDuplicates(["__k1", "__k2"]).select(*df.columns))
    return without_rows(left, key, again).union(once)
