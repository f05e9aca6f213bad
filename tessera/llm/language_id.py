"""Language identification by Bayesian evidence fusion (operator 6).

The posterior of a language multiplies the text's likelihood (byte trigrams)
with the evidence of the declared markup language, of the address suffix, and
of a host prior.  Declaration and suffix tables and host priors are grouped
counts over all rows; host priors are smoothed up a hierarchy: host, its
domain, everything.
"""

from __future__ import annotations

import dataclasses as dc

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

from tessera.llm.common import attach, materialize, ship_package, text_or_empty
from tessera.llm.url_filter import parts

BUCKETS = 1 << 15        # hashed byte trigrams
TRAIN_ROWS = 8_000       # documents of each known language the text model is counted on, about
GRID = 64                # weights of repeated texts are multiples of 1/GRID: sums don't depend on their order
TABLE_BYTES = 24 * 2 ** 20   # of the languages' tables that a pass over the texts uses
CELLS = 1 << 20          # rows times languages held together
TASK_LANGUAGES = 64      # languages whose counts a task holds at a time
SMOOTH = 0.5             # added to each trigram bucket
TEMPER = 30.0            # the text's log-likelihood is scaled to at most so many trigrams
HOST_PRIOR = 5.0         # pseudo-rows of the parent behind a host's and a domain's shares
TABLE_PRIOR = 2.0        # pseudo-rows in each cell of the declaration and suffix tables
BLOCK = 1 << 20          # bytes scored at a time


def _trigrams(block: bytes) -> np.ndarray:
    a = np.frombuffer(block, np.uint8).astype(np.uint32)
    return ((a[:-2] * 961 + a[1:-1] * 31 * 257 + a[2:] * 40503) & (BUCKETS - 1)) if len(a) > 2 \
        else np.zeros(0, np.uint32)


def _blocks(text: bytes):
    """Overlapping blocks that hold each trigram of a text once."""
    for at in range(0, len(text), BLOCK):
        yield text[at:at + BLOCK + 2]


@dc.dataclass
class TextModel:
    """``counts``: written rows (lang, bucket, n), the weighted trigram counts
    of each language; ``totals``: their sum for each of ``languages``."""
    languages: list[str]
    totals: list[float]
    counts: DataFrame

    def table(self, languages: list[str]) -> np.ndarray:
        """log P(trigram bucket | language), a column for each of a bounded
        number of languages."""
        rows = self.counts.where(F.col("lang").isin(languages)).toArrow()
        table = np.full((BUCKETS, len(languages)), SMOOTH)
        at = pc.index_in(rows["lang"], value_set=pa.array(languages, pa.string()))
        table[rows["bucket"].to_numpy(), at.to_numpy()] += rows["n"].to_numpy()
        return np.log(table / table.sum(axis=0))


def _sampled(known: DataFrame, train_rows: int) -> DataFrame:
    """(lang, weight, text): the distinct texts of the sample.  Whether a text
    that stands once is chosen follows from its hash and its language's share,
    so texts outside the sample don't move; texts that stand several times are
    looked up by their hash."""
    times = materialize(known.groupBy("lang", "h").agg(F.count("*").alias("n")), "language-texts")
    sizes = materialize(times.groupBy("lang").agg(F.sum("n").alias("n")), "language-sizes")
    shares = materialize(sizes.select(
        "lang", F.least(F.lit(1.0), train_rows / F.col("n")).alias("share")), "language-shares")
    part = F.shiftrightunsigned("h", 1) / F.lit(2.0 ** 63)
    due = F.col("share") * F.col("n")
    several = materialize(
        attach(times.where("n > 1"), shares, "lang", sizes)
        .where((due >= 1) | (part < due))
        .select("lang", "h", "n", F.greatest(F.lit(1.0), F.round(due * GRID) / GRID).alias("weight")),
        "language-repeated-texts")
    shared = attach(known, shares, "lang", sizes)
    once = attach(shared.where(part < F.col("share")), several.drop("n"), ["lang", "h"], several)
    more = attach(shared.where(part >= F.col("share")), several.drop("n"), ["lang", "h"], several,
                  "inner")
    return once.unionByName(more).dropDuplicates(["lang", "h"]).select(
        "lang", F.coalesce("weight", F.lit(1.0)).alias("weight"), "text")


def text_model(documents: DataFrame, lang_col: str, text_col: str, train_rows: int) -> TextModel:
    """Trigram counts over about ``train_rows`` documents of each known
    language, all of them where it has no more; a language is left out only if
    none of its texts has a trigram.

    Distinct texts are chosen by hash, with a chance in proportion to how
    often they stand in the language, and count as often as they would be
    expected in so many documents: a repeated text is neither wholly in nor
    wholly out.  Counts are summed in the tasks, then by language; the driver
    sees one row for each language, whatever their number.
    """
    text = text_or_empty(text_col).cast("binary")
    known = documents.select(F.col(lang_col).alias("lang"), F.xxhash64(text).alias("h"),
                             text.alias("text")).where(
        F.col("lang").isNotNull() & (F.length("text") > 0))

    def count(batches):
        sums: dict[str, np.ndarray] = {}

        def drain():
            for lang, own in sums.items():
                at = np.flatnonzero(own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)),
                     pa.array(own[at])], names=["lang", "bucket", "n"])
            sums.clear()

        for b in batches:
            for lang, weight, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(),
                                          b.column(2), strict=True):
                if lang not in sums and len(sums) == TASK_LANGUAGES:
                    yield from drain()
                own = sums.setdefault(lang, np.zeros(BUCKETS))
                for block in _blocks(text.as_py()):
                    own += weight * np.bincount(_trigrams(block), minlength=BUCKETS)
        yield from drain()

    counts = materialize(
        _sampled(known, train_rows).mapInArrow(count, "lang string, bucket int, n double")
        .groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "language-counts")
    rows = counts.groupBy("lang").agg(F.sum("n").alias("n")).orderBy("lang").collect()
    return TextModel([r.lang for r in rows], [r.n for r in rows], counts)


def text_scores(texts: DataFrame, model: TextModel) -> DataFrame:
    """Adds ``logp``, the tempered log-likelihoods, in place of ``text``.  The
    driver and a Python worker hold the table of as many languages as
    ``TABLE_BYTES`` take; with more languages the texts are scored in several
    passes."""
    languages = model.languages
    step = max(1, TABLE_BYTES // (4 * BUCKETS))
    starts = range(0, len(languages), step)
    if len(starts) < 2:
        return _block_scores(texts, model.table(languages), "logp", False)
    for k in starts:
        last = k == starts[-1]
        texts = _block_scores(texts, model.table(languages[k:k + step]), f"logp{k}", not last)
        if not last:
            texts = materialize(texts, "language-texts-scored")
    names = [f"logp{k}" for k in starts]
    return texts.withColumn("logp", F.concat(*names)).drop(*names)


def _block_scores(texts: DataFrame, table: np.ndarray, name: str, keep_text: bool) -> DataFrame:
    shared = texts.sparkSession.sparkContext.broadcast(table.astype(np.float32))
    at = texts.columns.index("text")
    wide = table.shape[1]
    rows = max(1, CELLS // wide)
    schema = StructType([f for f in texts.schema if keep_text or f.name != "text"]
                        + [StructField(name, ArrayType(DoubleType()))])

    def run(batches):
        model = shared.value
        for whole in batches:
            for start in range(0, whole.num_rows, rows):
                b = whole.slice(start, rows)
                out = np.zeros((b.num_rows, wide))
                for i, text in enumerate(b.column(at)):
                    n = 0
                    for block in _blocks(text.as_py()):
                        grams = _trigrams(block)
                        out[i] += np.bincount(grams, minlength=BUCKETS) @ model \
                            if len(grams) > BUCKETS else model[grams].sum(axis=0, dtype=np.float64)
                        n += len(grams)
                    if n:
                        out[i] *= min(n, TEMPER) / n
                ends = pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * wide)
                yield pa.RecordBatch.from_arrays(
                    [c for i, c in enumerate(b.columns) if keep_text or i != at]
                    + [pa.ListArray.from_arrays(ends, pa.array(out.ravel()))],
                    names=[f.name for f in schema])

    return texts.mapInArrow(run, schema)


def declared_language(html: Column) -> Column:
    """The primary tag of the ``lang`` attribute of ``<html>``, lower-cased;
    null without one."""
    tag = F.lower(F.regexp_extract(html, r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})\b", 1))
    return F.nullif(tag, F.lit(""))


def visible_text(html: Column) -> Column:
    """Markup without scripts, styles, comments and tags."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    return F.regexp_replace(bare, r"<[^>]*>", " ")


def _votes(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """(keys, n, ``name``): number of rows, and a map from language number to
    the number of texts that are most likely in it; written.  Votes are
    counted as long rows (keys, language, n); a map has as many entries as its
    key has languages."""
    votes = rows.groupBy(*keys, "best").agg(F.count("*").alias("n"))
    entries = F.filter(F.collect_list(F.struct("best", "n")), lambda e: e["best"].isNotNull())
    return materialize(votes.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.map_from_entries(entries).alias(name)), f"language-{name}")


def _total(votes: DataFrame, name: str, languages: int) -> np.ndarray:
    """Votes for each language: one row of each reaches the driver."""
    out = np.zeros(languages)
    for k, n in votes.select(F.explode(name).alias("k", "v")).groupBy("k").agg(F.sum("v")).collect():
        out[k] = n
    return out


def _dense(maps: pa.Array, wide: int) -> np.ndarray:
    """A row of ``wide`` numbers for each map of number -> count (null: none)."""
    out = np.zeros((len(maps), wide))
    ends = maps.offsets.to_numpy()
    rows = np.repeat(np.arange(len(maps)), np.diff(ends))
    keys, items = (x.slice(ends[0], ends[-1] - ends[0]).to_numpy() for x in (maps.keys, maps.items))
    out[rows, keys] = items
    return out


def posteriors(logp: np.ndarray, best: np.ndarray, hosted: np.ndarray, host: np.ndarray,
               domain: np.ndarray, evidence: list[tuple], every: np.ndarray) -> np.ndarray:
    """Log of the unnormalised posterior, rows by languages.

    ``best``: the language that each row's text votes for (-1: none);
    ``hosted``: rows with a host; ``host``, ``domain``, ``every``: votes by
    language; ``evidence``: for each table whether a row has a value, the votes
    of that value, those of all values, and the number of values.
    """
    wide = logp.shape[1]
    mine = np.zeros_like(logp)
    votes = np.flatnonzero(hosted & (best >= 0))
    mine[votes, best[votes]] = 1.0                       # a row's own vote is no evidence
    overall = (every + 1.0) / (every.sum() + wide)
    near = (domain - mine + HOST_PRIOR * overall) / (
        (domain - mine).sum(axis=1, keepdims=True) + HOST_PRIOR)
    prior = (host - mine + HOST_PRIOR * near) / (
        (host - mine).sum(axis=1, keepdims=True) + HOST_PRIOR)
    out = logp + np.log(np.where(hosted[:, None], prior, overall))
    for has, votes, total, values in evidence:
        table = np.log((votes + TABLE_PRIOR) / (total + TABLE_PRIOR * max(1, values)))
        out += np.where(has[:, None], table, 0.0)
    return out


def identify(rows: DataFrame, model: TextModel) -> DataFrame:
    """``rows`` has ``text`` (binary), ``host``, ``declared``, ``suffix`` and
    any other columns; ``text`` is replaced by ``lang`` and ``prob``, the most
    likely language and its posterior (the first by name among equals).

    A row's own vote is taken out of its host's and domain's counts; a text
    without trigrams has none.  Null
    host, declaration or suffix: no such evidence.  No text and no other
    evidence: the overall shares decide; no model at all: null.  Any number of
    languages: counts are rows, and a row's likelihoods are one array.
    """
    spark = rows.sparkSession
    ship_package(spark)
    languages = model.languages
    wide = len(languages)
    if not wide:
        return rows.drop("text", "host", "declared", "suffix").withColumns(
            {"lang": F.lit(None).cast("string"), "prob": F.lit(None).cast("double")})
    domain = F.regexp_extract("host", r"(?s)([^.]*\.)?[^.]*\z", 0)
    scored = materialize(text_scores(rows, model).withColumns({
        "domain": domain,
        "best": F.when(F.array_max("logp") < 0,          # no trigram: no vote
                       (F.array_position("logp", F.array_max("logp")) - 1).cast("int"))}),
        "language-scores")
    hosted = scored.where("host is not null")
    hosts = _votes(hosted, ["host"], "by_host")
    domains = _votes(hosted, ["domain"], "by_domain")
    out = attach(scored, hosts.drop("n"), "host", hosts)
    out = attach(out, domains.drop("n"), "domain", domains)
    every, sums = _total(domains, "by_domain", wide), []
    for column in ("declared", "suffix"):
        table = _votes(scored.where(F.col(column).isNotNull()), [column], f"by_{column}")
        out = attach(out, table.drop("n"), column, table)
        sums.append((_total(table, f"by_{column}", wide), table.count()))
    keep = [c for c in rows.columns if c not in ("text", "host", "declared", "suffix")]
    out = out.select(*keep, "logp", F.coalesce("best", F.lit(-1)).alias("best"), *[
        F.col(c).isNotNull().alias(f"has_{c}") for c in ("host", "declared", "suffix")],
        "by_host", "by_domain", "by_declared", "by_suffix")
    schema = StructType([*[f for f in rows.schema if f.name in keep],
                         StructField("lang", StringType()), StructField("prob", DoubleType())])
    sent = spark.sparkContext.broadcast((languages, every, sums))
    step = max(1, CELLS // wide)

    def run(batches):
        names, every, sums = sent.value
        names = pa.array(names, pa.string())
        for whole in batches:
            for start in range(0, whole.num_rows, step):
                b = whole.slice(start, step)
                col = dict(zip(b.schema.names[len(keep):], b.columns[len(keep):], strict=True))
                maps = {k: _dense(col[f"by_{k}"], wide) for k in ("host", "domain", "declared", "suffix")}
                has = {k: col[f"has_{k}"].to_numpy(zero_copy_only=False)
                       for k in ("host", "declared", "suffix")}
                evidence = [(has[k], maps[k], *total)
                            for k, total in zip(("declared", "suffix"), sums, strict=True)]
                post = posteriors(col["logp"].flatten().to_numpy().reshape(-1, wide),
                                  col["best"].to_numpy(), has["host"], maps["host"], maps["domain"],
                                  evidence, every)
                top = post.argmax(axis=1)
                least = post[np.arange(len(top)), top][:, None]
                yield pa.RecordBatch.from_arrays(
                    [*b.columns[:len(keep)], names.take(pa.array(top)),
                     pa.array(1.0 / np.exp(post - least).sum(axis=1))],
                    names=[f.name for f in schema])

    return out.mapInArrow(run, schema)


def page_rows(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
              html_col: str = "html") -> DataFrame:
    """Pages as ``identify`` takes them: visible text, host, declared language
    and address suffix (the host's last label)."""
    host, _ = parts(F.col(url_col))
    host = F.nullif(host, F.lit(""))
    return pages.select(
        F.col(id_col).alias(id_col),
        visible_text(text_or_empty(html_col)).cast("binary").alias("text"), host.alias("host"),
        declared_language(text_or_empty(html_col)).alias("declared"),
        F.regexp_extract(host, r"(?s)[^.]*\z", 0).alias("suffix"))


def document_rows(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  source_col: str = "source") -> DataFrame:
    """Documents as ``identify`` takes them: the source stands for the host;
    they declare no language and have no address."""
    none = F.lit(None).cast("string")
    return documents.select(
        F.col(id_col).alias(id_col), text_or_empty(text_col).cast("binary").alias("text"),
        F.col(source_col).alias("host"), none.alias("declared"), none.alias("suffix"))


def languages_of(documents: DataFrame, pages: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """Language of every document and page: ``doc_id`` or ``page_id`` (the
    other null), ``lang``, ``prob``.  The text model is counted on documents
    with a known language; their ``lang`` is not used as evidence.  Null texts
    count as empty; null ids and repeated rows pass through."""
    model = text_model(documents, "lang", "text", train_rows)
    both = document_rows(documents).withColumn("page_id", F.lit(None).cast("long")).unionByName(
        page_rows(pages).withColumn("doc_id", F.lit(None).cast("long")))
    return identify(both, model).select("doc_id", "page_id", "lang", "prob")
