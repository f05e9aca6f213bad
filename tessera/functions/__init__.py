"""Column-expression helpers (all JVM-side, code-generated)."""

from tessera.functions.naming import quote_ident, sql_literal, check_columns
from tessera.functions.random import (
    hash_u32, uniform_double, uniform_int, uuid4_text, letters, day_in_range,
)

__all__ = [
    "quote_ident", "sql_literal", "check_columns",
    "hash_u32", "uniform_double", "uniform_int", "uuid4_text", "letters",
    "day_in_range",
]
