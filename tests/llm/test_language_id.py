"""Language identification: accuracy, and each kind of evidence by itself."""

import collections
import math
import random

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import language_id as L
from tests.conftest import SF_ORACLE
from tests.llm.rows import SCHEMA, clashing, edge_frame, empty_frame

PAGES = "page_id long, url string, html string"


def test_documents_and_pages(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    pages = spark.read.parquet(f"{SF_ORACLE}/pages.parquet")
    # the model sees half of the languages; the other half is held out
    half = docs.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, F.col("lang")))
    rows = L.languages_of(half, pages).collect()
    truth = {r.doc_id: r.lang for r in docs.collect()}
    held = [r for r in rows if r.doc_id is not None and r.doc_id % 2]
    assert np.mean([truth[r.doc_id] == r.lang for r in held]) > 0.97
    tags = {r.page_id: r.tag for r in pages.select(
        "page_id", F.regexp_extract("url", "://[^/]+/([a-z]{2})/", 1).alias("tag")).collect()}
    assert np.mean([tags[r.page_id] == r.lang for r in rows if r.page_id is not None]) > 0.97
    assert len(rows) == len(truth) + len(tags)


def _model(spark):
    rows = [(i, ("the cat and the dog " if i % 2 else "der hund und die katze ") * 20,
             "en" if i % 2 else "de", "s", 0) for i in range(40)]
    return L.text_model(spark.createDataFrame(rows, SCHEMA), "lang", "text", 1000)


def test_trigram_counts(spark):
    model = _model(spark)
    assert model.languages == ["de", "en"]
    table = model.table(model.languages)
    counts = np.full(L.BUCKETS, L.SMOOTH)
    text = ("der hund und die katze " * 20).encode()
    for i in range(len(text) - 2):
        a, b, c = text[i:i + 3]
        counts[(a * 961 + b * 31 * 257 + c * 40503) & (L.BUCKETS - 1)] += 20
    assert np.allclose(table[:, 0], np.log(counts / counts.sum()))


def test_a_rare_language_has_a_model(spark):
    rows = [(i, f"the cat {i} and the dog {i * 7} ", "en", "s", 0) for i in range(3000)]
    rows += [(5000 + i, f"mbwa {i} na paka wawili ", "sw", "s", 0) for i in range(2)]
    model = L.text_model(spark.createDataFrame(rows, SCHEMA), "lang", "text", 50)
    assert model.languages == ["en", "sw"]
    df = spark.createDataFrame([("a", "paka wawili na mbwa", None, None, None),
                                ("b", "the dog and the cat", None, None, None)],
                               "id string, text string, host string, declared string, suffix string")
    got = L.identify(df.withColumn("text", F.encode("text", "utf-8")), model).collect()
    assert {r["id"]: r.lang for r in got} == {"a": "sw", "b": "en"}


def test_a_repeated_text_keeps_its_share_of_the_sample(spark):
    rows = [(i, f"{i * 7919 % 1000003:012d}" if i % 3 else "z" * 12, "en", "s", 0)
            for i in range(450)]
    table = L.text_model(spark.createDataFrame(rows, SCHEMA), "lang", "text", 60).table(["en"])
    counts = np.exp(table[:, 0] - table.min()) * L.SMOOTH - L.SMOOTH
    z = (ord("z") * (961 + 31 * 257 + 40503)) & (L.BUCKETS - 1)
    assert round(counts[z], 3) == 20 * 10          # 60 documents, a third of them, 10 trigrams
    assert 200 < counts.sum() - counts[z] < 600


def test_blocks_of_languages_give_the_same(spark, monkeypatch):
    words = {"de": "der hund und die katze", "en": "the cat and the dog", "sw": "mbwa na paka wawili"}
    rows = [(i, f"{t} {i}", k, "s", 0) for k, t in words.items() for i in range(20)]
    df = spark.createDataFrame(rows, SCHEMA)
    model = L.text_model(df, "lang", "text", 100)
    whole = sorted(map(tuple, L.identify(L.document_rows(df), model).collect()))
    monkeypatch.setattr(L, "TABLE_BYTES", 2 * 4 * L.BUCKETS)
    monkeypatch.setattr(L, "CELLS", 7)
    assert sorted(map(tuple, L.identify(L.document_rows(df), model).collect())) == whole
    assert len(whole) == 60


def test_evidence_decides_where_the_text_does_not(spark):
    rows = [(f"{k}{i}", t, f"h.{k}.x", k, k) for k, t in
            (("en", "the cat and the dog "), ("de", "der hund und die katze ")) for i in range(30)]
    rows += [("host", "", "h.de.x", None, None), ("declared", "", None, "de", None),
             ("suffix", "", None, None, "de"), ("nothing", "", None, None, None)]
    df = spark.createDataFrame(rows, "id string, text string, host string, declared string, "
                                     "suffix string").withColumn("text", F.encode("text", "utf-8"))
    got = {r["id"]: r for r in L.identify(df, _model(spark)).collect()}
    assert [got[k].lang for k in ("host", "declared", "suffix")] == ["de"] * 3
    assert got["host"].prob > 0.9 and got["declared"].prob > 0.9 and got["suffix"].prob > 0.9
    assert 0.4 < got["nothing"].prob < 0.6
    assert all(got[f"{k}{i}"].lang == k for k in ("en", "de") for i in range(30))


def test_empty_texts_have_no_vote(spark):
    """More empty than full texts at a host of the last language."""
    rows = [(f"full{i}", "the cat and the dog ", "h.x", "en", "x") for i in range(10)]
    rows += [(f"empty{i}", "", "h.x", "en", "x") for i in range(40)]
    rows += [(f"de{i}", "der hund und die katze ", "g.y", "de", "y") for i in range(10)]
    df = spark.createDataFrame(rows, "id string, text string, host string, declared string, "
                                     "suffix string").withColumn("text", F.encode("text", "utf-8"))
    got = {r["id"]: r.lang for r in L.identify(df, _model(spark)).collect()}
    assert {k: v for k, v in got.items() if v != ("de" if k[0] == "d" else "en")} == {}


def test_markup(spark):
    html = ["<html lang='FR-ca'>a<b>c</b>", "<!DOCTYPE html><html class=x lang=de><p>q", "<p lang=en>",
            "<html><script>var t='<p>no';</script><!-- lang --><p>yes</html>", ""]
    df = spark.createDataFrame([(h,) for h in html], "html string")
    rows = df.select(L.declared_language(F.col("html")).alias("d"),
                     F.trim(L.visible_text(F.col("html"))).alias("t")).collect()
    assert [r.d for r in rows] == ["fr", "de", None, None, None]
    assert [r.t.split() for r in rows] == [["a", "c"], ["q"], [], ["yes"], []]


def test_edge_rows(spark):
    pages = spark.createDataFrame([(1, None, None), (None, "http://a.b/", "<html lang=en>"),
                                   (2, "x", ""), (2, "x", "")], PAGES)
    df = clashing(edge_frame(spark), "page_id", "host", "best", "logp", "declared")
    rows = L.languages_of(df, clashing(pages, "doc_id", "suffix", "text")).collect()
    assert len(rows) == df.count() + 4
    assert L.languages_of(empty_frame(spark), pages.limit(0)).count() == 0
    assert {r.lang for r in L.languages_of(empty_frame(spark), pages).collect()} == {None}


def _brute(rows, model):
    """id -> (language, posterior): every step with plain loops over all rows."""
    names = model.languages
    counts = {k: collections.Counter() for k in names}
    for r in model.counts.collect():
        counts[r.lang][r.bucket] = r.n
    logp, best = {}, {}
    for i, text, *_ in rows:
        grams = [(a * 961 + b * 31 * 257 + c * 40503) & (L.BUCKETS - 1)
                 for a, b, c in zip(text, text[1:], text[2:], strict=False)]
        scale = min(len(grams), L.TEMPER) / max(1, len(grams))
        logp[i] = [scale * sum(math.log((counts[k][g] + L.SMOOTH)
                                        / (sum(counts[k].values()) + L.SMOOTH * L.BUCKETS)) for g in grams)
                   for k in names]
        best[i] = max(range(len(names)), key=lambda k: (logp[i][k], -k)) if grams else None
    domain = lambda h: ".".join(h.split(".")[-2:])

    def votes(fits):
        return [sum(best[r[0]] == k for r in rows if fits(r)) for k in range(len(names))]
    every = votes(lambda r: r[2] is not None)
    out = {}
    for i, _, host, declared, suffix in rows:
        overall = [(e + 1) / (sum(every) + len(names)) for e in every]
        prior = overall
        if host is not None:
            for fits in (lambda r: r[2] is not None and domain(r[2]) == domain(host),
                         lambda r: r[2] == host):
                own = votes(lambda r: fits(r) and r[0] != i)
                prior = [(v + L.HOST_PRIOR * p) / (sum(own) + L.HOST_PRIOR)
                         for v, p in zip(own, prior, strict=True)]
        post = [a + math.log(p) for a, p in zip(logp[i], prior, strict=True)]
        for at, value in ((3, declared), (4, suffix)):
            if value is not None:
                here, total = votes(lambda r: r[at] == value), votes(lambda r: r[at] is not None)
                values = len({r[at] for r in rows} - {None})
                post = [p + math.log((h + L.TABLE_PRIOR) / (t + L.TABLE_PRIOR * values))
                        for p, h, t in zip(post, here, total, strict=True)]
        top = max(post)
        out[i] = names[post.index(top)], 1 / sum(math.exp(p - top) for p in post)
    return out


def test_posteriors_by_plain_loops(spark):
    words = {"de": "der hund und die katze", "en": "the cat and the dog", "sw": "mbwa na paka wawili"}
    docs = [(i, f"{t} {i % 7}", k, "s", 0) for k, t in words.items() for i in range(12)]
    model = L.text_model(spark.createDataFrame(docs, SCHEMA), "lang", "text", 100)
    rng = random.Random(3)
    rows = []
    for i in range(60):
        k = rng.choice(list(words))
        text = " ".join(rng.choices(words[rng.choice([k, "en"])].split(), k=rng.randint(0, 3)))
        rows.append((i, text.encode(), rng.choice([f"{k}.a.x", f"h.{k}.y", "b", None]),
                     rng.choice([k, "zz", None]), rng.choice(["x", k, None])))
    df = spark.createDataFrame(rows, "id int, text binary, host string, declared string, suffix string")
    want = _brute(rows, model)
    got = {r["id"]: (r.lang, r.prob) for r in L.identify(df, model).collect()}
    assert got.keys() == want.keys()
    for i, (lang, prob) in want.items():
        assert abs(got[i][1] - prob) < 1e-4, (i, got[i], want[i])
        assert got[i][0] == lang or prob < 0.5001


def test_thousands_of_languages(spark):
    """Counts and priors are rows: plans don't grow with the languages."""
    rows = [(i, f"w{i * 7919:07d} v{i * 104729:08d} ", f"x-{i:04d}", f"s{i % 50}.h", 0) for i in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA)
    model = L.text_model(df, "lang", "text", 20)
    assert len(model.languages) == 3000
    few = df.where("doc_id % 30 = 0")
    got = L.identify(L.document_rows(few), model)
    right = [r.lang == f"x-{r.doc_id:04d}" for r in got.collect()]
    assert np.mean(right) > 0.95 and len(right) == 100
