"""Substring dedup against all windows; suffix array and factors by plain search."""

import random
import re

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import common
from tessera.llm import substring_dedup as S
from tessera.llm import words as W
from tests.llm.rows import SCHEMA, clashing, edge_frame, empty_frame, prose


def brute(rows):
    """(id, n_words, n_removed, kept) of every row, by all windows."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    least = {}
    for (i, _), ws in zip(rows, words, strict=True):
        for p in range(len(ws) - S.WINDOW + 1) if i is not None else ():
            w = tuple(ws[p:p + S.WINDOW])
            least[w] = min(least.get(w, i), i)
    out = []
    for (i, _), ws in zip(rows, words, strict=True):
        gone = set()
        for p in range(len(ws) - S.WINDOW + 1) if i is not None else ():
            if least[tuple(ws[p:p + S.WINDOW])] < i:
                gone.update(range(p, p + S.WINDOW))
        out.append((i, len(ws), len(gone), " ".join(w for k, w in enumerate(ws) if k not in gone)))
    return sorted(out, key=repr)


def check(df):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    got = S.without_repeats(df)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept"]
    want = brute(rows)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    return want


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", 0) for i, t in texts], SCHEMA)


def mixed(n, rng):
    """Passages of a small pool, cut anywhere, between words of each document."""
    pool = [prose(k, 90).split() for k in range(8)]
    out = []
    for i in range(n):
        words = prose(100 + i, rng.randint(0, 40)).split()
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(pool)
            a = rng.randrange(60)
            words += p[a:a + rng.randint(8, 30)] + [f"own{i}"] * rng.randint(0, 2)
        out.append((rng.randrange(10 * n), rng.choice(" \t\n\x0b").join(words)))
    return out


def test_word_codes():
    rng = random.Random(2)
    seen = {}
    for _ in range(300):
        text = bytes(rng.choice(b"ab \t\n\x0b\x0c\r\x1c\xc3\x00") for _ in range(rng.randrange(60)))
        codes = W.word_codes(text)
        words = text.split()
        assert len(codes) == len(words) and codes.all()
        for w, c in zip(words, codes.tolist(), strict=True):
            assert seen.setdefault(w, c) == c
    assert len(set(seen.values())) == len(seen)
    long = [b"x" * n for n in (W.LONG_WORD - 1, W.LONG_WORD, W.LONG_WORD + 1, 3 * W.CHUNK, 7)]
    text = b"  ".join(long * 2 + [b"word%d" % i for i in range(40_000)] + long)
    codes = W.word_codes(text)
    assert codes[:5].tolist() == codes[5:10].tolist() == codes[-5:].tolist()
    assert len(set(codes.tolist())) == 40_005


def test_longest_and_factors_by_plain_search():
    rng = random.Random(3)
    for _ in range(60):
        parts = [np.array([rng.randint(1, 3) for _ in range(rng.randint(1, 40))], np.uint64)
                 for _ in range(3)]
        block = S.Block(parts)
        words = np.array([rng.randint(1, 4) for _ in range(30)], np.uint64)
        texts = ["".join(map(str, p)) for p in parts]
        text = "".join(map(str, words))

        def longest(at):
            return max(n for n in range(len(text) - at + 1) if any(text[at:at + n] in t for t in texts))
        assert [block.longest(words, i) for i in range(30)] == [longest(i) for i in range(30)]
    base = np.arange(1, 60, dtype=np.uint64)
    block = S.Block([base[:25], base[15:50]])
    covered = {i for s, e in S.factors(base, block, S.grams(base, S.PROBE)) for i in range(s, e)}
    assert covered == set(range(50))


def test_all_windows(spark):
    rng = random.Random(5)
    want = check(frame(spark, mixed(150, rng)))
    assert sum(w[2] > 0 for w in want) > 50 and sum(w[2] == 0 for w in want) > 20


def test_windows_that_the_home_lacks(spark):
    """Document 1 holds the seeds of every window, but not the windows: the
    copy in document 3 of a passage of document 2 is found all the same."""
    words = prose(7, 60).split()
    shuffled = " ".join(" ".join(words[i:i + S.SEED_WORDS]) + f" z{i}" for i in range(0, 54))
    want = check(frame(spark, [(1, shuffled), (2, " ".join(words)), (3, "a " + " ".join(words))]))
    assert [w[2] for w in want] == [0, 0, 60]


def test_a_passage_in_a_third_of_all_documents(spark, monkeypatch):
    monkeypatch.setattr(S, "PIECES_PER_TASK", 20)
    passage = prose(1, 60)
    check(frame(spark, [(i, prose(50 + i, 25) + " " + (passage if i % 3 == 0 else "")) for i in range(300)]))


def test_repeats_inside_and_between_documents(spark):
    check(frame(spark, [(5, "a " * 40), (3, "a " * 13), (9, "a " * 12), (4, "b a " + "a " * 200)]))


def test_shuffled_joins_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(common, "HOT_ROWS", 10)
    monkeypatch.setattr(S, "HOT_ROWS", 10)
    check(frame(spark, mixed(80, random.Random(6))))


def test_edge_rows(spark):
    df = edge_frame(spark)
    df = df.union(df.withColumn("doc_id", F.col("doc_id") + 20)).union(df.limit(4))
    check(clashing(df, "doc", "row", "h", "home", "n", "start", "spans", "kept", "salt"))
    assert S.without_repeats(empty_frame(spark)).count() == 0
    named = df.withColumnsRenamed({"doc_id": "a.id", "text": "the text"})
    assert S.without_repeats(named, "a.id", "the text").count() == df.count()
    texts = df.withColumn("doc_id", F.col("doc_id").cast("string"))
    assert S.without_repeats(texts).where("n_removed > 0").count() > 0
