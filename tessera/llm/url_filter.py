"""URL filters: host rules, and gradient-boosted trees on lexical features
for the rest (operator 9).

Urls that a rule judges are the labelled ones; the trees learn from them.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import attach, materialize

# Rules by host and path, with their verdicts.
RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block",
         "org/fr/": "allow"}

TRAIN_ROWS = 4000        # labelled urls the trees are fitted on, by hash, about
TREES, DEPTH = 10, 3
SUFFIX_PRIOR = 20.0      # pseudo-urls at the overall rate behind a suffix's rate
FEATURES = ["length", "host_length", "depth", "digits", "entropy", "parameters", "labels",
            "hyphens", "suffix_rate"]


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path): the host stands after the first ``://`` up to ``/``,
    ``?``, ``#`` or the end, A-Z lower-cased; then the path up to ``?``, ``#``
    or the end.  Null or without ``://``: both empty."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, r"(?s)\A[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"(?s)\A[^?#]*", 0)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return lower, path


def matching_rule(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule whose host is the url's or a parent of it and whose
    path starts the url's; null without one."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        h, slash, p = rule.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(slash + p)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def _features(urls: DataFrame) -> DataFrame:
    """Lexical features of ``url``, ``host``, ``path``; null urls count as empty."""
    url = F.coalesce("url", F.lit(""))
    length = F.length(url)
    nonzero = F.greatest(length, F.lit(1))
    letters = F.split(url, "")
    counts = F.transform(F.array_distinct(letters), lambda c: (
        F.length(url) - F.length(F.replace(url, c, F.lit("")))) / nonzero)
    entropy = F.aggregate(counts, F.lit(0.0),
                          lambda a, p: a - F.when(p > 0, p * F.log2(p)).otherwise(0.0))
    return urls.withColumns({
        "length": length.cast("double"), "host_length": F.length("host").cast("double"),
        "depth": F.size(F.array_remove(F.split("path", "/"), "")).cast("double"),
        "digits": F.length(F.regexp_replace(url, "[^0-9]+", "")) / nonzero,
        "entropy": entropy,
        "parameters": F.when(url.contains("?"), 1 + F.length(url) - F.length(
            F.replace(url, F.lit("&"), F.lit("")))).otherwise(0).cast("double"),
        "labels": F.size(F.split("host", r"\.")).cast("double"),
        "hyphens": (F.length(url) - F.length(F.replace(url, F.lit("-"), F.lit("")))).cast("double"),
        "suffix": F.regexp_extract("host", r"(?s)[^.]*\z", 0)})


def judge_urls(df: DataFrame, rules: dict[str, str] | None = None, id_col: str = "page_id",
               url_col: str = "url", train_rows: int = TRAIN_ROWS) -> DataFrame:
    """One row per input row: the id, ``host``, ``path``, ``rule`` (null where
    none fits), ``verdict`` (the rule's, else the trees': ``block`` or
    ``allow``) and ``p_block`` (the trees' probability; null where they could
    not be fitted).

    The trees are fitted on distinct labelled urls, about half of ``train_rows``
    of either label (all, where there are fewer), taken by hash and weighted
    back to their share; suffix rates are counted over all labelled rows, less
    the row's own label, with ``SUFFIX_PRIOR`` pseudo-urls at the overall rate.  Where the
    labelled urls all have one label or there are none, the rest get that
    label, or ``allow``.  Null urls have empty host and path.  Null ids and
    repeated rows pass through; an empty table gives no rows; other columns
    are not read.
    """
    rules = RULES if rules is None else rules
    host, path = parts(F.col(url_col))
    found = df.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), host.alias("host"),
                      path.alias("path"))
    verdicts = F.create_map(*[F.lit(x) for kv in rules.items() for x in kv]) if rules else None
    rule = matching_rule(F.col("host"), F.col("path"), rules)
    block = F.when(rule.isNotNull(), (verdicts[rule] == "block").cast("double")) if rules \
        else F.lit(None).cast("double")
    urls = materialize(_features(found).withColumns({"rule": rule, "label": block}), "urls")

    suffixes = materialize(urls.groupBy("suffix").agg(
        F.count("*").alias("n"), F.count("label").alias("judged"),
        F.coalesce(F.sum("label"), F.lit(0.0)).alias("blocked")), "url-suffixes")
    judged, blocked = suffixes.agg(F.sum("judged"), F.sum("blocked")).first()
    judged, blocked = judged or 0, blocked or 0.0
    rate = blocked / judged if judged else 0.0
    own = F.when(F.col("label").isNull(), 0).otherwise(1)
    rows = attach(urls, suffixes.drop("n"), "suffix", suffixes).withColumn("suffix_rate", (
        F.col("blocked") - F.coalesce("label", F.lit(0.0)) + SUFFIX_PRIOR * rate)
        / (F.col("judged") - own + SUFFIX_PRIOR))
    if rate in (0.0, 1.0):
        rest = F.lit("block" if rate == 1.0 else "allow")
        scored, chance = rows, F.lit(None).cast("double")
    else:
        known = rows.where(F.col("label").isNotNull())
        different = dict(known.groupBy("label").agg(F.approx_count_distinct("url")).collect())
        shares = {k: min(1.0, 0.5 * train_rows / n) for k, n in different.items()}
        share = F.when(F.col("label") == 1, shares[1.0]).otherwise(shares[0.0])
        # 63 bits of the hash: the share may be as small as it has to
        sample = materialize(
            known.where(F.shiftrightunsigned(F.xxhash64("url"), 1) < share * 2.0 ** 63)
            .select("url", "label", (1 / share).alias("weight"), *FEATURES)
            .dropDuplicates(["url"]).coalesce(4), "url-sample")
        model = Pipeline(stages=[
            VectorAssembler(inputCols=FEATURES, outputCol="vector"),
            GBTClassifier(featuresCol="vector", labelCol="label",
                          weightCol="weight", maxIter=TREES, maxDepth=DEPTH,
                          maxBins=32, stepSize=0.3, seed=7)]).fit(sample)
        scored = model.transform(rows)
        chance = vector_to_array("probability")[1]
        rest = F.when(chance >= 0.5, "block").otherwise("allow")
    given = verdicts[F.col("rule")] if rules else F.lit(None).cast("string")
    return scored.select(F.col("id").alias(id_col), "host", "path", "rule",
                         F.coalesce(given, rest).alias("verdict"), chance.alias("p_block"))
