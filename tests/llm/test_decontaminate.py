"""Decontamination: planted copies, clean texts, alignment by the textbook."""

import random
import re

import numpy as np

from tessera.llm import decontaminate as D
from tests.llm.rows import SCHEMA, clashing, edge_frame, empty_frame, prose


def smith_waterman(a, b):
    h = np.zeros((len(a) + 1, len(b) + 1), int)
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            s = D.MATCH if a[i - 1] == b[j - 1] else D.MISMATCH
            h[i, j] = max(0, h[i - 1, j - 1] + s, h[i - 1, j] + D.GAP, h[i, j - 1] + D.GAP)
    return int(h.max())


def test_batched_alignment():
    rng = random.Random(4)
    pairs = [([rng.randrange(5) for _ in range(rng.randint(1, 30))],
              [rng.randrange(5) for _ in range(rng.randint(1, 12))]) for _ in range(200)]
    score, end = D.align([np.array(a) for a, _ in pairs], [np.array(b) for _, b in pairs])
    for (a, b), s, e in zip(pairs, score, end, strict=True):
        assert s == smith_waterman(a, b)
        assert smith_waterman(a[:e + 1], b) == s and (s == 0 or smith_waterman(a[:e], b) < s)


def items(n=30):
    return [(i, " ".join(f"w{i}x{j}" if j % 3 else "the" for j in range(20 + i))) for i in range(n)]


def frames(spark, docs, bench):
    return (spark.createDataFrame([(i, t, "en", "s", 0) for i, t in docs], SCHEMA),
            spark.createDataFrame(bench, "item_id long, text string"))


def test_exact_and_edited_copies_are_found(spark):
    rng = random.Random(7)
    docs, want = [(i, prose(i, 150)) for i in range(100)], set()
    for i, text in items():
        words = text.split()
        for _ in range(len(words) // 8):                       # replaced, put in, left out
            at = rng.randrange(len(words))
            words[at:at + 1] = rng.choice([["new"], [words[at], "more"], []])
        copies = (text, text.upper().replace(" ", ", "), " ".join(words))
        for k, copy in enumerate(copies):
            docs.append((1000 + 10 * i + k, prose(i, 90) + " " + copy + "\n" + prose(i + 1, 50)))
            want.add((1000 + 10 * i + k, i))
    df, bench = frames(spark, docs, items())
    got = D.contaminated(df, bench).collect()
    assert {(r.id, r.item_id) for r in got} == want
    texts = dict(docs)
    for r in got:
        if r.score == 1.0:
            words = re.findall(r"[a-z0-9]+", texts[r.id].lower())
            assert words[r.first_word:r.last_word + 1] == dict(items())[r.item_id].split()
    left = {r.doc_id for r in D.without_contaminated(df, bench).collect()}
    assert left == set(texts) - {i for i, _ in want}


def test_a_passage_in_a_third_of_all_documents_is_found_everywhere(spark):
    (_, leaked), *_ = bench = items(5)
    docs = [(i, prose(i, 60) + (" " + leaked if i % 3 == 0 else " the the the")) for i in range(300)]
    df, b = frames(spark, docs, bench)
    assert {r.id for r in D.contaminated(df, b).collect()} == {i for i in range(300) if i % 3 == 0}


def test_many_edited_and_partial_copies_are_found(spark):
    """As many documents hold the same copy, in which fewer than half of the
    item's 3-grams are left, as make its own seeds common."""
    words = [f"v{j}" for j in range(38)]
    bench = [(1, " ".join(words)), (2, " ".join(f"u{j}" for j in range(38)))]
    partial = " ".join(words[:18])
    edited = " ".join(f"e{j}" if j % 4 == 3 else f"u{j}" for j in range(38))
    for n in (21, 1000):
        docs = [(i, prose(i, 30) + f" {copy} " + prose(i + 1, 20)) for i, copy in
                enumerate([partial] * n + [edited] * n + [""] * n)]
        df, b = frames(spark, docs, bench)
        got = sorted((r.id, r.item_id, round(r.score, 2)) for r in D.contaminated(df, b).collect())
        assert got == [(i, 1, 0.47) for i in range(n)] + [(n + i, 2, 0.64) for i in range(n)]


def test_pairs_that_are_not_aligned_could_not_reach_the_score():
    rng = random.Random(5)
    for _ in range(500):
        a, b = ([str(rng.randrange(9)) for _ in range(rng.randint(1, n))] for n in (30, 12))
        assert D.may_align(a, b) or smith_waterman(a, b) / (D.MATCH * len(b)) < D.MIN_SCORE


def test_common_grams_alone_are_no_leak(spark):
    bench = [(1, "the the the " + " ".join(f"q{j}" for j in range(15)))]
    df, b = frames(spark, [(i, "the the the and so on " + prose(i, 30)) for i in range(200)], bench)
    assert D.contaminated(df, b).count() == 0


def edited(words, rate, rng):
    """Each word replaced, left out or followed by another at ``rate``."""
    out = []
    for w in words:
        if rng.random() < rate:
            out += rng.choice([["new%d" % rng.randrange(999)], [], [w, "more%d" % rng.randrange(999)]])
        else:
            out.append(w)
    return out


def test_recall_against_the_alignment_of_all_pairs(spark):
    """Documents with copies at edit rates of 0 to 40 percent, and every third
    word replaced: of the pairs that align, at least 0.9 are found, and no
    other."""
    rng = random.Random(9)
    bench = [(i, " ".join(rng.choice("the of and to a in is it".split()) if rng.random() < 0.4
                          else f"k{rng.randrange(400)}" for _ in range(rng.randint(8, 45))))
             for i in range(40)]
    docs = []
    for n, rate in enumerate([0, 0.1, 0.2, 0.3, 0.4] * 16):
        copy = edited(bench[n % 40][1].split(), rate, rng)
        docs.append((n, prose(n, 30) + " " + " ".join(copy) + " " + prose(n + 1, 30)))
    for n, (_, text) in enumerate(bench):
        thirds = [f"x{n}y{j}" if j % 3 == 2 else w for j, w in enumerate(text.split())]
        docs.append((1000 + n, prose(n, 25) + " " + " ".join(thirds)))
    want = set()
    for i, text in docs:
        codes = {}
        code = lambda t: np.array([codes.setdefault(w, len(codes)) for w in t.split()])  # noqa: E731, B023
        items = [code(b) for _, b in bench]
        best, _ = D.align([code(text)] * len(items), items)
        want |= {(i, b) for (b, _), s, c in zip(bench, best, items, strict=True)
                 if s / (D.MATCH * len(c)) >= D.MIN_SCORE}
    df, b = frames(spark, docs, bench)
    got = {(r.id, r.item_id) for r in D.contaminated(df, b).collect()}
    assert got <= want
    assert len(got) >= 0.97 * len(want) and len(want) > 90
    thirds = {w for w in want if w[0] >= 1000}
    assert len(thirds) > 30 and len(got & thirds) >= 0.9 * len(thirds)


def test_items_that_share_a_phrase_with_all_documents(spark, monkeypatch):
    """n documents and n items with one common phrase make no n * n pairs."""
    seen = []
    kept = D.Seeds.stretches
    for n in (50, 200):
        bench = [(i, "which of the following " + " ".join(f"i{i}w{j}" for j in range(16))) for i in range(n)]
        docs = [(i, prose(i, 20) + " which of the following " + prose(i + 1, 20)) for i in range(n)]
        docs.append((n, prose(3, 9) + " " + bench[7][1]))
        seeds = D.Seeds([D.word_codes(t.encode()) for _, t in bench])
        rare = np.ones(len(seeds.hashes), bool)
        seen.append(sum(len(kept(seeds, D.word_codes(t.encode()), rare)) for _, t in docs))
        df, b = frames(spark, docs, bench)
        assert [(r.id, r.item_id) for r in D.contaminated(df, b).collect()] == [(n, 7)]
    assert seen == [1, 1] or max(seen) <= 4


def test_every_item_has_a_seed_and_short_ones_are_found(spark):
    bench = [(i, "one two three") for i in range(40)] + [(99, "one two three four")]
    df, b = frames(spark, [(1, "zero one two three four"), (2, "one two"), (3, "one two three")], bench)
    got = {(r.id, r.item_id) for r in D.contaminated(df, b).collect()}
    assert got == {(d, i) for d in (1, 3) for i in [*range(40), 99]}


def test_edge_rows(spark):
    bench = spark.createDataFrame(
        [(1, None), (2, ""), (3, "one two"), (None, prose(1, 20)), (4, prose(1, 20)),
         (4, prose(1, 20))], "item_id long, text string")
    df = clashing(edge_frame(spark), "id", "k1", "words", "item", "score", "places")
    got = sorted(((r.id, r.item_id) for r in D.contaminated(df, bench).collect()), key=repr)
    assert got == sorted([(1, None), (1, 4), (4, None), (4, 4)], key=repr)
    assert D.contaminated(empty_frame(spark), bench).count() == 0
    assert D.contaminated(df, bench.limit(0)).count() == 0
    dotted = df.withColumnsRenamed({"doc_id": "a.id", "text": "the text"})
    assert D.contaminated(dotted, bench, "a.id", "the text").count() == 4
    assert D.without_contaminated(dotted, bench, "a.id", "the text").columns == dotted.columns


def test_blocks_of_the_benchmark_give_the_same(spark, monkeypatch):
    docs = [(i, prose(i, 50) + " " + t) for i, t in items(12)]
    df, b = frames(spark, docs, items(12))
    whole = sorted(map(tuple, D.contaminated(df, b).collect()))
    monkeypatch.setattr(D, "BLOCK_WORDS", 100)
    assert sorted(map(tuple, D.contaminated(df, b).collect())) == whole and len(whole) == 12
