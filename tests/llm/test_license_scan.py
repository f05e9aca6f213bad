"""Licence scan against plain word matching."""

import re

from tessera.llm import license_scan as L
from tests.llm.rows import SCHEMA, clashing, edge_frame, empty_frame, prose


def brute(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(L.WORD, text)
    places, labels = [], set()
    for phrase, label in L.PHRASES.items():
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i:i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return (len(words), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(labels)))


def run(df):
    got = L.license_labels(df).collect()
    want = [(r.doc_id, *brute(r.text)) for r in df.collect()]
    assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)
                   for r in got), key=repr) == sorted(want, key=repr)
    return {r.doc_id: r for r in got}


def texts(spark, *texts):
    return spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], SCHEMA)


def test_edge_rows(spark):
    run(clashing(edge_frame(spark), "k1", "words", "pos", "label", "labels", "n"))


def test_phrases_are_counted_everywhere(spark):
    run(texts(spark, "MIT license mit-license, MIT\nLICENSE", "the GNU General Public License.",
              "gnu general public licence", "cc by cc by cc", "apache license " * 40,
              "apacheKlicense MİT license", "é mit license ñ", "mit", "license mit"))


def test_templates_are_found_with_edits(spark):
    whole = dict((label, text) for label, text in L.TEMPLATES if label in ("bsd", "mpl", "lgpl"))
    bsd = whole["bsd"].split()
    edited = " ".join(bsd[:8] + ["also"] + bsd[8:])          # a word put in
    cut = " ".join(bsd[:6])                                  # too little of it
    got = run(texts(spark, prose(1, 50) + " " + whole["bsd"] + " " + prose(2, 50), edited, cut,
                    whole["mpl"].upper(), prose(3, 300)))
    assert [got[i].labels for i in range(5)] == ["bsd", "bsd", "", "mpl", ""]
    assert got[0].score == 1.0 and 0.6 <= got[1].score < 1.0 and got[4].score == 0.0


def test_spans(spark):
    rows = L.scan(texts(spark, prose(1, 50) + " " + L.TEMPLATES[3][1])).collect()
    assert [(r.label, r.start, r.stop, r.share) for r in rows] == [
        ("bsd", 50, 50 + len(re.findall(L.WORD, L.TEMPLATES[3][1].lower())), 1.0)]


def test_empty_table(spark):
    assert L.license_labels(empty_frame(spark)).count() == 0
