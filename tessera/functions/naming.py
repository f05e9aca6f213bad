"""Identifier and literal handling: names are checked and quoted, never pasted."""

from __future__ import annotations

import datetime as _dt
import decimal as _dec

from pyspark.sql import DataFrame


def quote_ident(name: str) -> str:
    """Back-quote one identifier part (``db.table`` is split and quoted per part)."""
    if not isinstance(name, str) or not name:
        raise ValueError(f"bad identifier: {name!r}")
    return ".".join("`" + p.replace("`", "``") + "`" for p in name.split("."))


def sql_literal(value) -> str:
    """A Spark SQL literal for a partition value (string, number, date, bool)."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, (int, _dec.Decimal)):
        return str(value)
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, _dt.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, _dt.date):
        return f"DATE '{value.isoformat()}'"
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def check_columns(df: DataFrame, *names: str) -> None:
    """Raise a clear error when a named column is missing (case-insensitive)."""
    have = {c.lower() for c in df.columns}
    missing = [n for n in names if n.lower() not in have]
    if missing:
        raise ValueError(f"columns {missing} not in {df.columns}")
