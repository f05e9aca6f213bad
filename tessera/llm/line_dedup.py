"""Line dedup over overlapping three-line windows (operator 2).

Every window of three consecutive lines is hashed; windows found more than
once anywhere are looked up, all occurrences but the first are covered, and
the covered lines go.  DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import (
    attach, broadcast_if_bounded, fresh_name, materialize, text_or_empty,
)

WINDOW = 3                        # lines in a window
WORD = r"[^\x20\x09-\x0D]"        # a line without such a character is blank


def _windows(docs: DataFrame) -> DataFrame:
    """(id, k, pos, h1, h2, at): one row per window with a line that isn't
    blank; ``at`` orders windows by document id, 31 bits of the text's hash,
    then position."""
    at = [F.col("lines")[F.col("pos") + i] for i in range(WINDOW)]
    n = F.size("lines")
    starts = F.when(n >= WINDOW, F.sequence(F.lit(0), n - WINDOW))
    whole = lambda c: c.cast("decimal(20,0)")
    place = F.shiftrightunsigned("k", 33).bitwiseAND(F.lit(2 ** 31 - 1)) * F.lit(2 ** 31) + F.col("pos")
    order = (F.coalesce(whole(F.col("id")), whole(F.lit(-(2 ** 63))))
             * F.lit(2 ** 62).cast("decimal(19,0)") + place)
    worded = at[0].rlike(WORD)
    for line in at[1:]:
        worded = worded | line.rlike(WORD)
    return (docs.select("id", "k", F.split("text", "\n", -1).alias("lines"))
            .select("id", "k", "lines", F.explode_outer(starts).alias("pos"))
            .where(F.col("pos").isNotNull() & worded)
            .select("id", "k", "pos", F.xxhash64(*at).alias("h1"),
                    F.xxhash64(F.lit(1), *reversed(at)).alias("h2"),
                    order.cast("decimal(38,0)").alias("at")))


def covered_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, k, gone): for each document that loses lines, the numbers of its
    lines (from 0) covered by a later occurrence of a repeated window.
    ``k`` is the hash of the text."""
    t = text_or_empty(f"`{text_col}`")
    docs = df.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(t).alias("k"), t.alias("text"))
    windows = _windows(docs)
    repeated = materialize(
        windows.groupBy("h1", "h2").agg(F.min("at").alias("first"), F.count("*").alias("n"))
        .where("n > 1"), "line-windows")
    found = attach(windows, repeated.drop("n"), ["h1", "h2"], repeated, "inner")
    return (found.where("at > first").groupBy("id", "k")
            .agg(F.collect_set("pos").alias("starts"))
            .select("id", "k", F.array_distinct(F.flatten(F.transform(
                "starts", lambda p: F.sequence(p, p + (WINDOW - 1))))).alias("gone")))


def _left(text: Column, gone: Column) -> Column:
    """The text without the lines whose numbers are in ``gone``.  The lines
    are bound once, as the one element of an outer array; an expression used
    inside the lambda would be split again for every line."""
    def keep(lines: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
        return F.array_join(F.transform(stay, lambda i: lines[i]), "\n")

    return F.transform(F.array(F.split(text, "\n", -1)), keep)[0]


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input with ``text`` freed of repeated passages, and two more
    columns: ``n_lines`` and ``n_removed`` (named with underscores in front
    where the input has such columns).

    A window is three consecutive lines (split at ``\\n``), not all blank.
    Its first occurrence (smallest id, then text hash, then position) stays;
    each line that a later occurrence covers goes, also inside one document.
    A line that goes stands unchanged at an earlier place, so no line's text is
    lost.  Texts of fewer than three lines stay as they are; a text whose every
    line goes becomes empty, its row stays.  Null text counts as empty and
    stays null; null ids come first; different texts of one id, or without
    one, follow each other by their hash; exact repetitions of a row hold one
    place and stay alike.  ``id_col`` is an integer column.
    """
    gone = materialize(covered_lines(df, id_col, text_col), "line-cover")
    key, text = fresh_name(df, "k"), text_or_empty(f"`{text_col}`")
    lines_total, lines_gone = fresh_name(df, "n_lines"), fresh_name(df, "n_removed")
    small = broadcast_if_bounded(gone)
    right = (gone if small is None else small).alias("g")
    docs = df.withColumn(key, F.xxhash64(text)).alias("d")
    joined = docs.join(right, (F.col(f"d.{key}") == F.col("g.k"))
                       & F.col(f"d.`{id_col}`").eqNullSafe(F.col("g.id")), "left")
    kept = [F.when(F.col("g.gone").isNull(), F.col(f"d.`{c}`"))
            .otherwise(_left(F.col(f"d.`{c}`"), F.col("g.gone"))).alias(c) if c == text_col
            else F.col(f"d.`{c}`") for c in df.columns]
    return joined.select(
        *kept, F.size(F.split(text_or_empty(F.col(f"d.`{text_col}`")), "\n", -1)).cast("long")
        .alias(lines_total),
        F.coalesce(F.size("g.gone"), F.lit(0)).cast("long").alias(lines_gone))
