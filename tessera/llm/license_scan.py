"""Licence scans by diagonal voting (operator 7).

Every rolling word k-gram of the texts is joined to the positions of the
templates that hold it; matches vote for the diagonal (text position minus
template position); neighbouring diagonals are merged into one span, and the
span is verified by the share of the template it covers.  Fixed phrases are
templates of a single k-gram.  DataFrame operations only.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import attach, fresh_name, materialize, row_key, text_or_empty

# The phrases whose places are counted, with their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Sentences of public licence notices, with their labels.
TEMPLATES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of "
            "this software and associated documentation files, to deal in the software without "
            "restriction, including without limitation the rights to use, copy, modify, merge, "
            "publish, distribute, sublicense, and/or sell copies of the software"),
    ("apache", "Licensed under the Apache License, Version 2.0 (the License); you may not use "
               "this file except in compliance with the License. You may obtain a copy of the "
               "License at"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, "
            "are permitted provided that the following conditions are met"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the "
            "terms of the GNU General Public License as published by the Free Software "
            "Foundation"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the "
             "terms of the GNU Lesser General Public License as published by the Free Software "
             "Foundation"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, "
            "v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain "
            "one at"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International "
              "License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 "
                 "International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
                 "International License"),
    ("mit", "Released under the MIT License"),
    ("proprietary", "All rights reserved. No part of this publication may be reproduced, "
                    "distributed, or transmitted in any form or by any means"),
]

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GRAM = 4                 # words of a template's k-grams
SLACK = 3                # diagonals this close are one span: so many words put in or left out
MIN_SHARE = 0.6          # share of a template's k-grams that a span must hold


def text_words(text: Column) -> Column:
    """Array of the words, A-Z lower-cased.  The two characters that ``lower``
    would turn into ASCII letters are masked first (they stay word characters)."""
    safe = F.replace(F.replace(text, F.lit("K"), F.lit("ÿ")),
                     F.lit("İ"), F.lit("ÿ"))
    return F.array_remove(F.split(F.lower(safe), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def template_grams(spark: SparkSession, phrases: dict[str, str],
                   templates: list[tuple[str, str]]) -> DataFrame:
    """(size, gram, template, label, is_phrase, grams, tpos): the k-grams of
    all templates; as many rows as the templates have words."""
    rows, sizes = [], set()
    for number, (label, text, whole) in enumerate(
            [(b, a, True) for a, b in phrases.items()] + [(a, b, False) for a, b in templates]):
        words = re.findall(WORD, text.lower())
        size = len(words) if whole else min(GRAM, len(words))
        starts = range(len(words) - size + 1)
        sizes.add(size)
        rows += [(size, words[p:p + size], number, label, whole, len(starts), p) for p in starts]
    return spark.createDataFrame(
        rows, "size int, gram array<string>, template int, label string, is_phrase boolean, "
              "grams int, tpos int"), sorted(sizes)


def _matches(docs: DataFrame, spark: SparkSession, phrases, templates) -> DataFrame:
    """(k1, k2, template, label, is_phrase, grams, tpos, pos), each once."""
    grams, sizes = template_grams(spark, phrases, templates)
    grams = grams.withColumn("h", F.xxhash64("gram"))
    at = [F.get("words", F.col("pos") + i) for i in range(sizes[-1])]
    n = F.size("words")
    rolled = (docs.select("k1", "k2", "words", F.explode_outer(
        F.when(n > 0, F.sequence(F.lit(0), n - 1))).alias("pos")).where("pos is not null")
        .select("k1", "k2", "words", "pos", F.explode(F.array(*[
            F.xxhash64(*at[:s]) for s in sizes])).alias("h")))
    # the templates are a parameter of a few hundred words, never data
    return (rolled.join(F.broadcast(grams), "h")
            .where(F.slice("words", F.col("pos") + 1, F.col("size")) == F.col("gram"))
            .select("k1", "k2", "template", "label", "is_phrase", "grams", "tpos", "pos")
            .distinct())


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         phrases: dict[str, str] | None = None,
         templates: list[tuple[str, str]] | None = None) -> DataFrame:
    """One row per licence place: ``k1``, ``k2`` (row key), ``template``,
    ``label``, ``is_phrase``, ``start``, ``stop`` (words from 0, stop
    exclusive) and ``share`` (of the template's k-grams found, 1 for a phrase)."""
    docs = df.select(*row_key(id_col, text_or_empty(text_col)),
                     text_words(text_or_empty(text_col)).alias("words"))
    hits = _matches(docs, df.sparkSession, PHRASES if phrases is None else phrases,
                    TEMPLATES if templates is None else templates)
    place = ["k1", "k2", "template", "label", "is_phrase", "grams"]
    votes = (hits.groupBy(*place, (F.col("pos") - F.col("tpos")).alias("diagonal"))
             .agg(F.count("*").alias("votes"), F.collect_set("tpos").alias("tpos"),
                  F.min("pos").alias("first"), F.max("pos").alias("last")))
    order = Window.partitionBy(*place).orderBy("diagonal")
    gap = F.when(F.col("is_phrase"), 0).otherwise(SLACK)
    parts = votes.withColumn("new", F.coalesce(
        (F.col("diagonal") - F.lag("diagonal").over(order) > gap).cast("int"), F.lit(1)))
    spans = (parts.withColumn("span", F.sum("new").over(order)).groupBy(*place, "span")
             .agg(F.size(F.array_distinct(F.flatten(F.collect_list("tpos")))).alias("found"),
                  F.min("first").alias("start"), F.max("last").alias("last"),
                  F.sum("votes").alias("votes")))
    share = F.col("found") / F.col("grams")
    size = F.when(F.col("is_phrase"), F.lit(0)).otherwise(GRAM)
    return spans.where(share >= MIN_SHARE).select(
        "k1", "k2", "template", "label", "is_phrase", "start",
        (F.col("last") + size).alias("stop"), share.alias("share"))


def license_labels(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   phrases: dict[str, str] | None = None,
                   templates: list[tuple[str, str]] | None = None) -> DataFrame:
    """One row per input row: the id, ``n_words``, ``n_base`` (places where a
    phrase's words stand consecutively), ``first_word`` and ``last_word`` (the
    smallest and largest start of such a place, else null), ``base_labels``,
    ``labels`` (distinct, sorted, comma-joined; empty without any) and
    ``score`` (the largest share of a template found, 1 for a phrase, else 0).

    Null text counts as empty; null ids pass through; repeated rows each get
    the same values; texts are scanned whole; other columns are not read.
    """
    found = scan(df, id_col, text_col, phrases, templates)
    base = F.when(F.col("is_phrase"), F.col("start"))
    per_text = materialize(found.groupBy("k1", "k2").agg(
        F.count(base).alias("n_base"), F.min(base).cast("long").alias("first_word"),
        F.max(base).cast("long").alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(F.col("is_phrase"), F.col("label")))), ",")
        .alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set("label")), ",").alias("labels"),
        F.max("share").alias("score")), "license-labels")
    words = df.select(F.col(id_col).alias(fresh_name(per_text, id_col)),
                      *row_key(id_col, text_or_empty(text_col)),
                      F.size(text_words(text_or_empty(text_col))).cast("long").alias("n_words"))
    counts = per_text.select("k1", "k2", F.lit(1).alias("n"))
    return attach(words, per_text, ["k1", "k2"], counts).select(
        F.col(fresh_name(per_text, id_col)).alias(id_col), "n_words",
        F.coalesce("n_base", F.lit(0)).alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))
