"""SimHash groups against all pairs."""

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from tessera.llm import common, simhash
from tests.llm.rows import SCHEMA, clashing, edge_frame, empty_frame, prose


def fingerprint(text, k=3):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def group(keys, near):
    """Smallest reachable key index of every key, by all pairs."""
    parent = list(range(len(keys)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a
    for a in range(len(keys)):
        for b in range(a):
            if near(keys[a], keys[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return [find(a) for a in range(len(keys))]


def check(df, bits=2):
    rows = [(r.doc_id, fingerprint(r.text)) for r in df.collect()]
    roots = group([f for _, f in rows], lambda a, b: (a ^ b).bit_count() <= bits)
    least = {}
    for (i, _), root in zip(rows, roots, strict=True):
        if i is not None:
            least[root] = min(least.get(root, i), i)
    want = [(i, f"{f:016x}", least.get(root)) for (i, f), root in zip(rows, roots, strict=True)]
    got = simhash.near_duplicates(df, 3, bits)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    return rows, roots


def near_copies(n):
    rng = random.Random(1)
    rows = []
    for i in range(n):
        words = prose(i % 9, 400).split(" ")
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = "edit"
        rows.append((i, " ".join(words), "en", "s", 0))
    return rows


def test_edge_rows(spark):
    check(clashing(edge_frame(spark), "id", "fp", "k1", "root", "variant"))


@pytest.mark.parametrize("bits", [0, 2, 4])
def test_near_copies(spark, bits):
    check(spark.createDataFrame(near_copies(120), SCHEMA), bits)


def test_shuffled_lookups_with_salts_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(common, "HOT_ROWS", 5)
    check(spark.createDataFrame(near_copies(80), SCHEMA))


def test_components_of_chains_and_stars(spark):
    rng = random.Random(2)
    edges = [(i + 1, i) for i in range(40)] + [(1000 + i, 999) for i in range(50)]
    edges += [(rng.randrange(2001, 2200), rng.randrange(2000, 2100)) for _ in range(150)]
    edges = [(max(e), min(e)) for e in edges if e[0] != e[1]]
    got = dict(map(tuple, simhash.components(spark.createDataFrame(
        edges, "child long, parent long")).collect()))
    nodes = sorted({x for e in edges for x in e})
    pairs = set(edges)
    roots = group(nodes, lambda a, b: (a, b) in pairs)
    assert {n: nodes[r] for n, r in zip(nodes, roots, strict=True) if nodes[r] != n} == got


def test_one_of_each_group_stays(spark):
    df = spark.createDataFrame(near_copies(60), SCHEMA).union(edge_frame(spark).select(
        F.col("doc_id") + 500, "text", "lang", "source", "n_chars"))
    rows = df.collect()
    roots = group([fingerprint(r.text) for r in rows], lambda a, b: (a ^ b).bit_count() <= 2)
    left = simhash.keep_one(df).collect()
    assert len(left) == len(set(roots))
    ids = {}
    for r, root in zip(rows, roots, strict=True):
        if r.doc_id is not None:
            ids[root] = min(ids.get(root, r.doc_id), r.doc_id)
    assert {r.doc_id for r in left if r.doc_id is not None} == set(ids.values())
    twice = simhash.keep_one(df.union(df)).collect()
    assert sorted(map(repr, twice)) == sorted(map(repr, left))


def test_odd_radius_and_empty_table(spark):
    with pytest.raises(ValueError):
        simhash.near_duplicates(edge_frame(spark), 3, 3)
    assert simhash.near_duplicates(empty_frame(spark)).count() == 0
    assert simhash.keep_one(empty_frame(spark)).count() == 0
