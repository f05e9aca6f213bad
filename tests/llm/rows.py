"""Rows that every operator must take: nulls, empty and long texts, ties,
repeated rows, columns with clashing names."""

from __future__ import annotations

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron".split()


def prose(seed: int, words: int, line: int = 12) -> str:
    """Repeatable text: ``words`` words, a line break every ``line``."""
    out, x = [], seed * 2654435761 % 2 ** 32
    for i in range(words):
        x = (x * 1103515245 + 12345) % 2 ** 31
        out.append(WORDS[x % len(WORDS)] + str(x // 65536 % 97))
        out.append("\n" if (i + 1) % line == 0 else " ")
    return "".join(out).strip()


def edge_rows() -> list[tuple]:
    base = prose(1, 60)
    return [
        (1, base, "en", "a", None), (2, None, "en", "a", 0), (3, "", None, None, 0),
        (None, prose(2, 40), "en", None, 5), (4, base, "en", "a", 5), (4, base, "en", "a", 5),
        (5, " \n\t \n", "de", "b", 3), (6, "x", "de", "b", 1), (7, prose(3, 20_000), "en", "a", 0),
        (8, "é<|endoftext|>中 \U0001F600  ", "fr", "c", 4), (None, None, None, None, None),
        (9, "A" * 50_000, "en", "a", 1),
    ]


def edge_frame(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


def clashing(df, *names):
    """``df`` with further columns of the names that an operator uses."""
    from pyspark.sql import functions as F
    return df.withColumns({n: F.lit("clash") for n in names if n not in df.columns})


def empty_frame(spark):
    return spark.createDataFrame([], SCHEMA)
