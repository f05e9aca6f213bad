"""Quality rules: robust multivariate outliers (operator 3).

Per text a vector of transformed statistics; per language and source a
minimum-covariance-determinant estimate of its centre and spread (C-steps
from two deterministic starts, the smaller determinant wins), drawn towards
the language's the fewer rows it has; texts whose Mahalanobis distance is too
large are rejected.  DataFrame operations only:
each C-step is one grouped aggregation, the 4 x 4 algebra is column
arithmetic.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import attach, materialize, row_key, text_or_empty

SPACES = r"[\x20\x09-\x0D]+"
REPEAT_WINDOW = 8         # words
MIN_CELL = 24             # rows of a (language, source) for an estimate of its own
PRIOR_ROWS = 30           # further rows at which it weighs about as much as its language's
KEEP_SHARE = 0.6          # share of a cell that the determinant is minimised over
STEPS = 5                 # C-steps from each start
CUTOFF = 25.0             # squared distance beyond which a text is rejected
PRIOR_WORDS = 50          # pseudo-words that steady the rates of short texts
PRIOR_CHARS = 5.0         # characters of a pseudo-word
#: Least standard deviation of each statistic: most texts have no symbols,
#: repeated lines or repeated windows at all, so their spread may be zero.
FLOORS = {"x1": 0.06, "x2": 0.12, "x3": 0.08, "x4": 0.08}
X = list(FLOORS)
PAIRS = [(i, j) for i in range(len(X)) for j in range(i + 1)]
GRID = 4096               # statistics are multiples of 1/GRID: sums don't depend on their order


def consistency(share: float, p: int = len(X)) -> float:
    """Factor that makes the covariance of the innermost ``share`` of normal
    rows estimate the whole covariance (``p`` even)."""
    def tail(t: float, terms: int) -> float:     # P(chi2 with 2*terms degrees > 2t)
        return math.exp(-t) * sum(t ** k / math.factorial(k) for k in range(terms))

    low, high = 0.0, 100.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if 1 - tail(mid, p // 2) < share else (low, mid)
    return share / (1 - tail(low, p // 2 + 1))


def _repeated_words(hashes: Column) -> Column:
    """Words covered by windows whose hash occurs twice or more."""
    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def twice(s: Column) -> Column:
        return F.transform(
            F.filter(s, lambda x, j: ((j > 0) & (F.get(s, j - 1)["h"] == x["h"]))
                     | ((j < F.size(s) - 1) & (F.get(s, j + 1)["h"] == x["h"]))),
            lambda x: x["i"])

    def widths(starts: Column) -> Column:
        last = F.size(starts) - 1
        return F.transform(starts, lambda p, k: F.when(k == last, REPEAT_WINDOW).otherwise(
            F.least(F.lit(REPEAT_WINDOW), F.get(starts, k + 1) - p)))

    starts = F.sort_array(F.transform(F.array(pairs), twice)[0])
    return F.aggregate(F.transform(F.array(starts), widths)[0], F.lit(0), lambda a, b: a + b)


def text_statistics(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """One row per input row: ``id``, ``k1``, ``k2`` (row key), ``lang``,
    ``source``, the base statistics and ``base_failed``."""
    t = text_or_empty(text_col)
    key = row_key(F.struct(id_col, lang_col, source_col), t)
    own = [F.col(c).alias(a) for c, a in ((id_col, "id"), (lang_col, "lang"), (source_col, "source"))]
    words = df.select(
        *own, *key, F.array_remove(F.split(t, SPACES), "").alias("words"),
        F.filter(F.split(t, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        F.length(F.regexp_replace(t, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"))
    n = F.size("words")
    hashed = words.select(
        "id", "k1", "k2", "lang", "source", n.cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"), "n_symbols",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(n > REPEAT_WINDOW, F.transform(
            F.sequence(F.lit(1), n - (REPEAT_WINDOW - 1)),
            lambda i: F.xxhash64(F.slice("words", i, REPEAT_WINDOW)))).alias("hashes"))
    repeats = F.when(F.size(F.array_distinct("hashes")) < F.size("hashes"),
                     _repeated_words(F.col("hashes"))).otherwise(0).cast("long")
    return (hashed.withColumn("n_repeat_words", repeats).drop("hashes")
            .withColumn("base_failed", (F.col("n_words") < 20)
                        | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))))


def _vector(stats: DataFrame) -> DataFrame:
    """Adds ``x1`` .. ``x4``: log word length, log symbol rate, share of
    repeated lines, share of repeated words, steadied for short texts."""
    n = F.col("n_words") + PRIOR_WORDS
    x = [F.log((F.col("word_chars") + PRIOR_CHARS * PRIOR_WORDS) / n),
         F.log1p(10 * F.col("n_symbols") / n),
         F.col("n_dup_lines") / (F.col("n_lines") + 5),
         F.col("n_repeat_words") / n]
    return stats.withColumns({a: F.round(b * GRID) / GRID for a, b in zip(X, x, strict=True)})


def _with_cells(stats: DataFrame) -> DataFrame:
    """Adds ``cell``: the (language, source) if it has ``MIN_CELL`` rows that
    pass the base rules, else ``lang_cell``; and ``lang_cell``: the language
    if it has as many, else all that are left.  Null values are values of
    their own."""
    fine, lang = F.to_json(F.struct("lang", "source")), F.to_json(F.struct("lang"))
    rows = stats.withColumns({"fine": fine, "coarse": lang})
    counts = rows.where("not base_failed").groupBy("fine", "coarse").agg(F.count("*").alias("n"))
    totals = counts.groupBy("coarse").agg(F.sum("n").alias("total"))
    lang_cell = F.when(F.col("total") >= MIN_CELL, F.concat(F.lit("1"), "coarse")).otherwise("0")
    cells = materialize(
        counts.join(totals, "coarse").select(
            "fine", "n", F.when(F.col("n") >= MIN_CELL, F.concat(F.lit("2"), "fine"))
            .otherwise(lang_cell).alias("cell"), lang_cell.alias("lang_cell")), "quality-cells")
    rows = rows.drop("coarse")
    return attach(rows, cells.drop("n"), "fine", cells).drop("fine")


def _factored(means: DataFrame) -> DataFrame:
    """From columns ``m_i`` and ``c_i_j`` (covariance) to ``m_i`` and the
    Cholesky factor ``l_i_j``; the floors are added to the diagonal."""
    out = means
    for i, j in PAIRS:
        s = F.col(f"c_{i}_{j}")
        if i == j:
            s = s + FLOORS[X[i]] ** 2
        for k in range(j):
            s = s - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
        out = out.withColumn(f"l_{i}_{j}", F.sqrt(s) if i == j else s / F.col(f"l_{j}_{j}"))
    return out.drop(*[f"c_{i}_{j}" for i, j in PAIRS])


def _distance(rows: DataFrame) -> DataFrame:
    """Adds ``d2``, the squared Mahalanobis distance, by forward substitution."""
    names = []
    for i, x in enumerate(X):
        z = F.col(x) - F.col(f"m_{i}")
        for j in range(i):
            z = z - F.col(f"l_{i}_{j}") * F.col(f"z_{j}")
        names.append(f"z_{i}")
        rows = rows.withColumn(f"z_{i}", z / F.col(f"l_{i}_{i}"))
    return rows.withColumn("d2", sum((F.col(z) * F.col(z) for z in names[1:]),
                                     F.col("z_0") * F.col("z_0"))).drop(*names)


def _sums() -> list[Column]:
    return ([F.count("*").alias("n")] + [F.sum(x).alias(f"s_{i}") for i, x in enumerate(X)]
            + [F.sum(F.col(X[i]) * F.col(X[j])).alias(f"q_{i}_{j}") for i, j in PAIRS])


def _moments(sums: DataFrame, factor: float) -> DataFrame:
    m = [(F.col(f"s_{i}") / F.col("n")) for i in range(len(X))]
    return sums.select("cell", "start", *[a.alias(f"m_{i}") for i, a in enumerate(m)],
                       *[((F.col(f"q_{i}_{j}") / F.col("n") - m[i] * m[j]) * factor)
                         .alias(f"c_{i}_{j}") for i, j in PAIRS])


def robust_estimates(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """Per ``cell`` with rows: centre ``m_i`` and factor ``l_i_j`` of the
    subset of ``KEEP_SHARE`` of its rows with the smaller determinant.

    A C-step groups rows by cell and a fine bin of their distance, adds bins
    up from the inside until the share is reached, and takes the moments of
    those.  Bins bound what a cell gathers (about 32 per e-fold of distance),
    however many rows it has.
    """
    overall = _moments(rows.groupBy("cell", F.lit("mean").alias("start")).agg(*_sums()), 1.0)
    quartiles = rows.groupBy("cell").agg(
        *[F.percentile(x, [0.25, 0.5, 0.75]).alias(x) for x in X])
    middle = quartiles.select(
        "cell", F.lit("median").alias("start"),
        *[F.col(x)[1].alias(f"m_{i}") for i, x in enumerate(X)],
        *[(F.pow((F.col(X[i])[2] - F.col(X[i])[0]) / 1.349, 2) if i == j else F.lit(0.0))
          .alias(f"c_{i}_{j}") for i, j in PAIRS])
    estimates = materialize(_factored(overall.unionByName(middle)), "quality-start")
    totals = [f"s_{i}" for i in range(len(X))] + [f"q_{i}_{j}" for i, j in PAIRS]
    for step in range(STEPS):
        near = _distance(attach(rows, estimates, "cell", counts, "inner"))
        bins = near.groupBy("cell", "start", F.floor(F.log(F.col("d2") + 1e-6) * 32)
                            .alias("bin")).agg(*_sums())
        inner = ("sum(n) over (partition by cell, start order by bin) - n "
                 f"< {KEEP_SHARE} * sum(n) over (partition by cell, start)")
        subset = (bins.withColumn("inner", F.expr(inner)).where("inner")
                  .groupBy("cell", "start").agg(*[F.sum(c).alias(c) for c in ["n", *totals]]))
        estimates = materialize(_factored(_moments(subset, consistency(KEEP_SHARE))),
                                f"quality-step{step}")
    volume = sum((F.log(f"l_{i}_{i}") for i in range(1, len(X))), F.log("l_0_0"))
    best = estimates.groupBy("cell").agg(
        F.min_by(F.struct(*[c for c in estimates.columns if c not in ("cell", "start")]),
                 F.struct(F.round(volume, 9), "start")).alias("e"))
    return materialize(best.select("cell", "e.*"), "quality-estimates")


def _shrunk(estimates: DataFrame, links: DataFrame) -> DataFrame:
    """The estimates, those of sources drawn towards their language's: the
    moments of a mixture of both, the source's with the weight w / (w +
    ``PRIOR_ROWS``), where w is 1 for ``MIN_CELL`` rows and one more for each
    further row.  ``links`` (written) has ``cell``, ``lang_cell`` and
    ``passed``, the rows that the cell's estimate is made of."""
    fine = links.where("cell != lang_cell")
    langs = materialize(
        estimates.join(fine.select(F.col("lang_cell").alias("cell")).distinct(), "cell", "left_semi")
        .select(F.col("cell").alias("lang_cell"),
                *[F.col(c).alias("of_" + c) for c in estimates.columns if c != "cell"]),
        "quality-languages")
    load = fine.groupBy("lang_cell").agg(F.count("*").alias("n"))
    both = attach(estimates.join(fine, "cell"), langs, "lang_cell", load, "inner")
    rows = F.col("passed") - (MIN_CELL - 1)
    w = rows / (rows + PRIOR_ROWS)
    apart = [F.col(f"m_{i}") - F.col(f"of_m_{i}") for i in range(len(X))]

    def cov(of: str, i: int, j: int) -> Column:
        return sum((F.col(f"{of}l_{i}_{k}") * F.col(f"{of}l_{j}_{k}") for k in range(1, j + 1)),
                   F.col(f"{of}l_{i}_0") * F.col(f"{of}l_{j}_0"))

    # _factored adds the floors, which both spreads hold already
    mixed = both.select(
        "cell", *[(F.col(f"of_m_{i}") + w * apart[i]).alias(f"m_{i}") for i in range(len(X))],
        *[(w * cov("", i, j) + (1 - w) * cov("of_", i, j) + w * (1 - w) * apart[i] * apart[j]
           - (FLOORS[X[i]] ** 2 if i == j else 0.0)).alias(f"c_{i}_{j}") for i, j in PAIRS])
    whole = estimates.join(fine.select("cell"), "cell", "left_anti")
    return materialize(_factored(mixed).unionByName(whole), "quality-shrunk")


def judge(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """One row per input row: the id, ``k1``, ``k2`` (row key), ``n_words``,
    ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``,
    ``base_failed``, ``distance`` and ``kept``.

    Base rules first (fewer than 20 words; over 30 % of the words in repeated
    8-word windows); ``distance`` is the Mahalanobis distance from the robust
    centre of the row's cell, null where no cell has an estimate (then the
    base rules decide alone).  Null text counts as empty; null languages and
    sources are values of their own; a source's estimate is drawn towards its
    language's the fewer rows it has, and is the language's below ``MIN_CELL``
    rows.  Repeated rows each count and each get their row; an empty table
    gives no rows; other columns are not read.
    """
    stats = materialize(_vector(text_statistics(df, id_col, text_col, lang_col, source_col)),
                        "quality-stats")
    rows = materialize(_with_cells(stats).select(
        "id", "k1", "k2", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "cell", "lang_cell", *X), "quality-rows")
    links = materialize(rows.where("cell is not null").groupBy("cell", "lang_cell").agg(
        F.count("*").alias("n"), F.count_if(~F.col("base_failed")).alias("passed")), "quality-links")
    counts = materialize(
        links.select(F.explode(F.array_distinct(F.array("cell", "lang_cell"))).alias("cell"), "n")
        .groupBy("cell").agg(F.sum("n").alias("n")), "quality-counts")
    # a source's rows also make its language's estimate
    fitted = rows.where("not base_failed").select(
        F.explode(F.array_distinct(F.array("cell", "lang_cell"))).alias("cell"), *X)
    estimates = _shrunk(robust_estimates(fitted, counts), links)
    far = _distance(attach(rows, estimates, "cell", counts))
    return far.select(
        F.col("id").alias(id_col), "k1", "k2", "n_words", "word_chars", "n_symbols",
        "n_dup_lines", "n_repeat_words", "base_failed", F.sqrt("d2").alias("distance"),
        (~F.col("base_failed") & F.coalesce(F.col("d2") <= CUTOFF, F.lit(True))).alias("kept"))
