"""Seeded pseudo-random column expressions.

Every value is a pure function of ``(seed, column name, row id)``: the md5 of
``"<seed>:<name>:<id>"``.  So a task retry, a re-read, a different partition
count or another engine (the DuckDB oracle) gives exactly the same rows.
``rand(seed)``, ``uuid()`` and ``monotonically_increasing_id`` depend on the
partition layout and are not used.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The letter alphabet of the generated text columns, in order.
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"

_TWO_POW_32 = 4294967296.0


def _key(seed: int, name: str, id_col: Column, block: int | None = None) -> Column:
    parts = [F.lit(f"{seed}:{name}:"), id_col.cast("string")]
    if block is not None:
        parts += [F.lit(f":{block}")]
    return F.concat(*parts)


def hex_digest(seed: int, name: str, id_col: Column, block: int | None = None) -> Column:
    """32 hex digits of md5 for one (seed, column, id[, block])."""
    return F.md5(_key(seed, name, id_col, block))


def _hex_to_long(hex_text: Column) -> Column:
    return F.conv(hex_text, 16, 10).cast("bigint")


def hash_u32(seed: int, name: str, id_col: Column) -> Column:
    """Unsigned 32-bit number from the first 8 hex digits of the md5."""
    return _hex_to_long(F.substring(hex_digest(seed, name, id_col), 1, 8))


def uniform_double(seed: int, name: str, id_col: Column) -> Column:
    """Double in [0, 1)."""
    return hash_u32(seed, name, id_col) / F.lit(_TWO_POW_32)


def uniform_int(seed: int, name: str, id_col: Column, n: int) -> Column:
    """Int in [0, n)."""
    return (hash_u32(seed, name, id_col) % F.lit(n)).cast("int")


def uuid4_text(seed: int, name: str, id_col: Column) -> Column:
    """Version-4, variant-1 UUID text (36 chars) shaped from one md5."""
    h = hex_digest(seed, name, id_col)
    variant = F.substring(F.lit("89ab"),
                          (F.lit(1) + _hex_to_long(F.substring(h, 17, 1)) % 4).cast("int"), 1)
    return F.concat(
        F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-4"),
        F.substring(h, 14, 3), F.lit("-"), variant, F.substring(h, 18, 3), F.lit("-"),
        F.substring(h, 21, 12))


# Letters are drawn 6 at a time from one 52-bit number (13 hex digits of the
# md5 stream): the base-52 digits 0..5 of a uniform 52-bit value are uniform
# to within 52**6 / 2**52 (about 5e-6).  One hex-to-number conversion per six
# letters keeps the generator cheap.
LETTERS_PER_CHUNK = 6
HEX_PER_CHUNK = 13


def letter_chunk_count(length: int) -> int:
    return -(-length // LETTERS_PER_CHUNK)


def letters_digest(seed: int, name: str, id_col: Column, length: int) -> Column:
    """Concatenated md5 blocks: enough hex digits for ``length`` letters."""
    blocks = -(-letter_chunk_count(length) * HEX_PER_CHUNK // 32)
    return F.concat(*[hex_digest(seed, name, id_col, b) for b in range(blocks)])


def letter_chunks(digest: Column, length: int) -> list[Column]:
    """The 52-bit numbers the letters are read from (13 hex digits each)."""
    return [_hex_to_long(F.substring(digest, 1 + HEX_PER_CHUNK * c, HEX_PER_CHUNK))
            for c in range(letter_chunk_count(length))]


def _letter(alphabet: str, digit: Column) -> Column:
    return F.substring(F.lit(alphabet), (F.lit(1) + digit).cast("int"), 1)


def letters_from_chunks(chunks: list[Column], length: int, alphabet: str = ALPHABET) -> Column:
    """Letter i = alphabet[base-n digit (i mod 6) of chunk (i div 6)].

    Inline form: the digit is computed exactly as ``(v - v % n**j) / n**j``
    (a multiple of ``n**j`` below 2**53, so the division is exact).
    """
    n = len(alphabet)
    picks = []
    for i in range(length):
        v, j = chunks[i // LETTERS_PER_CHUNK], i % LETTERS_PER_CHUNK
        p = n ** j
        digit = (((v - v % F.lit(p)) / F.lit(p)).cast("bigint") % F.lit(n)) if j else v % F.lit(n)
        picks.append(_letter(alphabet, digit))
    return F.concat(*picks)


def letters_from_chunk_columns(names: list[str], length: int, alphabet: str = ALPHABET) -> Column:
    """Same letters as ``letters_from_chunks`` from already projected chunk
    columns: two letters at a time are looked up in a table of all pairs, and
    one expression runs over the chunks.  Written out letter by letter, the
    generated code of a record is larger than what the JVM compiles (8000
    bytes a method) and runs interpreted."""
    if not names:
        return F.lit("")
    n = len(alphabet)
    sep = next(c for c in map(chr, range(31, 0, -1)) if c not in alphabet)
    pairs = F.split(F.lit(sep.join(a + b for b in alphabet for a in alphabet)), sep)

    def chunk_text(text: Column, chunk: Column) -> Column:
        digits = [F.call_function("div", chunk, F.lit(n ** j)) % F.lit(n * n)
                  for j in range(0, LETTERS_PER_CHUNK, 2)]
        return F.concat(text, *[F.get(pairs, d.cast("int")) for d in digits])

    chunks = F.array(*[F.col("`" + name.replace("`", "``") + "`") for name in names])
    text = F.aggregate(chunks, F.lit(""), chunk_text)
    return text if length % LETTERS_PER_CHUNK == 0 else F.substring(text, 1, length)


def letters(seed: int, name: str, id_col: Column, length: int,
            alphabet: str = ALPHABET) -> Column:
    """Random text of ``length`` letters as one expression.  For bulk use,
    ``records_for_ids`` computes digest and chunks in earlier projections so
    each md5 and conversion runs once per row."""
    chunks = letter_chunks(letters_digest(seed, name, id_col, length), length)
    return letters_from_chunks(chunks, length, alphabet)


def day_in_range(seed: int, name: str, id_col: Column,
                 start: _dt.date, end: _dt.date) -> Column:
    """Date in [start, end), whole days."""
    days = (end - start).days
    if days <= 0:
        raise ValueError("end must be after start")
    return F.date_add(F.lit(start), (hash_u32(seed, name, id_col) % F.lit(days)).cast("int"))
