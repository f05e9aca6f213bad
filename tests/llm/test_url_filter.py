"""URL filter: parts and rules by brute force, trees on held-out urls."""

import math
import re

from pyspark.sql import functions as F

from tessera.llm import common
from tessera.llm import url_filter as U
from tests.llm.rows import clashing

URLS = [None, "", "x", "http://", "http://a.net", "http://a.net/", "HTTP://A.NET/x?y#z", "a://b://c/",
        "https://example.net/en/1", "https://m.example.net/en/", "https://notexample.net/en/2",
        "https://example.com/de/x", "https://example.com/d", "http://x.org/fr/", "http://org/fr/?q",
        "http://é.org/fr/ä", "://q.net/#/", "http://u@a.net:80/p", "http://a.net?x/y", "ß\n://\nnet/a"]


def brute(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host):]).group()
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in U.RULES for h, p in [r.split("/", 1)]
            if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    return host, path, max(fits, key=len, default=None)


def test_parts_and_rules(spark):
    df = spark.createDataFrame([(i if i % 5 else None, u) for i, u in enumerate(URLS * 2)],
                               "page_id long, url string")
    got = U.judge_urls(clashing(df, "host", "path", "label", "suffix", "html")).collect()
    want = [(i, *brute(u)) for i, u in map(tuple, df.collect())]
    assert sorted(((r.page_id, r.host, r.path, r.rule) for r in got), key=repr) == sorted(want, key=repr)
    for r in got:
        assert r.verdict == (U.RULES[r.rule] if r.rule else r.verdict) and r.verdict in ("block", "allow")


def test_trees_learn_held_out_urls(spark):
    """Urls of one shape are blocked by rule; unruled ones of that shape follow."""
    rows = [(i, f"http://{'spam-deals-x' if i % 2 else 'news'}{i}.{'bad' if i % 2 else 'good'}.io/"
                + ("7" * 30 + "?a=1&b=2" if i % 2 else "story")) for i in range(400)]
    rows += [(1000 + i, u.replace(".bad.io", ".other").replace(".good.io", ".other"))
             for i, u in rows[:100]]
    df = spark.createDataFrame(rows, "page_id long, url string")
    got = {r.page_id: r for r in U.judge_urls(df, {"bad.io/": "block", "good.io/": "allow"}).collect()}
    right = sum((got[i].verdict == "block") == (i % 2 == 1) for i in range(1000, 1100))
    assert right >= 95 and got[1000].rule is None


def _sample(spark, df, monkeypatch, **more):
    """The rows that the trees are fitted on."""
    kept = []

    def seen(frame, name):
        out = common.materialize(frame, name)
        if name == "url-sample":
            kept.append(out)
        return out
    monkeypatch.setattr(U, "materialize", seen)
    U.judge_urls(df, {"bad.io/": "block", "good.io/": "allow"}, **more)
    return kept[0]


def test_every_labelled_url_is_fitted_below_the_bound(spark, monkeypatch):
    """Urls with equal features are different urls; repeated urls count once."""
    rows = [(i, f"http://{'ab'[i % 2]}{i % 200:04d}.{'bad' if i % 2 else 'good'}.io/") for i in range(600)]
    df = spark.createDataFrame(rows, "page_id long, url string")
    sample = _sample(spark, df, monkeypatch)
    assert sample.count() == 200 and sample.where("weight = 1").count() == 200
    assert sample.select(*U.FEATURES).distinct().count() < 20
    part = _sample(spark, df, monkeypatch, train_rows=50)
    assert 25 <= part.count() <= 85
    weights = {r.label: r.w for r in part.groupBy("label").agg(F.sum("weight").alias("w")).collect()}
    assert all(40 < w < 180 for w in weights.values()) and len(weights) == 2


def test_features_by_hand(spark):
    urls = ["http://a.bad.io/x/yy?a=1&b=2#f", "http://good.io/7-7-é", "http://aa.bad.io/", None, "x"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    host, path = U.parts(F.col("url"))
    got = {r.page_id: r for r in U._features(df.withColumns({"host": host, "path": path})).collect()}
    for i, url in enumerate(urls):
        u, (h, p, _) = url or "", brute(url)
        share = [u.count(c) / len(u) for c in set(u)]
        want = {"length": len(u), "host_length": len(h), "depth": len([x for x in p.split("/") if x]),
                "digits": sum(c in "0123456789" for c in u) / max(1, len(u)),
                "entropy": -sum(s * math.log2(s) for s in share),
                "parameters": 1 + u.count("&") if "?" in u else 0, "labels": len(h.split(".")),
                "hyphens": u.count("-"), "suffix": h.split(".")[-1]}
        for k, v in want.items():
            assert got[i][k] == v if k == "suffix" else abs(got[i][k] - v) < 1e-9, (i, k)


def test_suffix_rates_leave_the_own_label_out(spark, monkeypatch):
    rows = [(i, f"http://h{i}.{'bad' if i % 4 == 0 else 'good'}.io/") for i in range(40)]
    sample = _sample(spark, spark.createDataFrame(rows, "page_id long, url string"), monkeypatch)
    for r in sample.collect():
        rate = (10 - r.label + U.SUFFIX_PRIOR * 0.25) / (40 - 1 + U.SUFFIX_PRIOR)
        assert abs(r.suffix_rate - rate) < 1e-12


def test_one_label_no_label_and_empty(spark):
    df = spark.createDataFrame([(1, "http://a.net/"), (2, "http://b.xyz/")], "page_id long, url string")
    assert {r.page_id: r.verdict for r in U.judge_urls(df).collect()} == {1: "block", 2: "block"}
    assert {r.verdict for r in U.judge_urls(df, {}).collect()} == {"allow"}
    assert U.judge_urls(df.where(F.lit(False))).count() == 0
