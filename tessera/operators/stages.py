"""Shuffle-stage operators of the stage flow: group, join, cube, plus the narrow
projections (add one, cast, rename) and the global count."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.naming import check_columns
from tessera.operators.joins import prefix_columns, skew_join


def add_one(df: DataFrame, column: str = "BENEFITS") -> DataFrame:
    """Replace ``column`` by ``column + 1`` (null stays null); narrow, codegen'd."""
    check_columns(df, column)
    return df.withColumn(column, F.col(column) + F.lit(1))


def cast_column(df: DataFrame, column: str, to: str = "timestamp", alias: str | None = None) -> DataFrame:
    """Cast one column (e.g. DATE -> timestamp at midnight)."""
    check_columns(df, column)
    return df.withColumn(alias or column, F.col(column).cast(to))


def rename_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rename all columns by position; the count of names must match."""
    if len(names) != len(df.columns):
        raise ValueError(f"{len(names)} names for {len(df.columns)} columns")
    return df.toDF(*names)


def group_sum(df: DataFrame, field: str, value: str = "BENEFITS",
              alias: str | None = None, exact_decimal: str | None = None) -> DataFrame:
    """``GROUP BY field`` -> ``sum(value)``.  Partial aggregation runs before
    the shuffle, so a hot key costs one row per task, not its row count.

    ``exact_decimal`` (e.g. ``"decimal(18,2)"``) sums in fixed point, which is
    order-independent; the result is cast back to double.
    """
    check_columns(df, field, value)
    v = F.col(value)
    if exact_decimal:
        total = F.sum(v.cast(exact_decimal)).cast("double")
    else:
        total = F.sum(v)
    return df.groupBy(field).agg(total.alias(alias or f"sum({value})"))


def cube_avg_max(df: DataFrame, field: str, second: str = "ADDRESS",
                 avg_col: str = "BENEFITS", max_col: str = "BALANCE",
                 avg_alias: str | None = None, max_alias: str | None = None,
                 avg_digits: int | None = None) -> DataFrame:
    """``CUBE(field, second)`` -> ``avg(avg_col)``, ``max(max_col)`` and ``gid``.

    ``gid`` (grouping id: 2 * grouping(field) + grouping(second)) tells subtotal
    rows from groups whose key is a real null.
    """
    check_columns(df, field, second, avg_col, max_col)
    avg = F.avg(avg_col)
    if avg_digits is not None:
        avg = F.round(avg, avg_digits)
    return df.cube(field, second).agg(
        F.grouping_id(field, second).alias("gid"),
        avg.alias(avg_alias or f"avg({avg_col})"),
        F.max(max_col).alias(max_alias or f"max({max_col})"),
    )


def join_inner(left: DataFrame, right: DataFrame, left_on: str, right_on: str | None = None,
               right_prefix: str | None = None, hot_rows: int | None = None) -> DataFrame:
    """Inner equi-join; optionally prefix every right column first so no name
    is duplicated (duplicate names cannot be written).

    ``hot_rows``: split keys of ``left`` with more rows than this over
    several tasks (see ``skew_join``); otherwise Spark/AQE choose.
    """
    right_on = right_on or left_on
    check_columns(left, left_on)
    check_columns(right, right_on)
    if right_prefix:
        right = prefix_columns(right, right_prefix)
        right_on = right_prefix + right_on
    if hot_rows:
        # join on the left key name; the right key stays as its own column
        keyed = right.withColumn("__key", F.col(right_on))
        out = skew_join(left.withColumn("__key", F.col(left_on)), keyed, "__key", "inner",
                        hot_rows)
        return out.drop("__key")
    if right_on == left_on:
        return left.join(right, left_on, "inner")
    return left.join(right, left[left_on] == right[right_on], "inner")


def join_inner_using(left: DataFrame, right: DataFrame, field: str,
                     right_prefix: str | None = "r_", hot_rows: int | None = None,
                     hot: DataFrame | None = None) -> DataFrame:
    """``JOIN ... USING (field)``: the key once, then the rest of the left
    columns, then the rest of the right (prefixed when names collide).
    ``hot``: the left side's hot keys where they are known (``hot_keys``)."""
    check_columns(left, field)
    check_columns(right, field)
    if right_prefix:
        clash = set(left.columns) - {field}
        right = right.select(*[F.col(c).alias(right_prefix + c if c in clash else c)
                               for c in right.columns])
    if hot_rows:
        # a USING join on (field, salt): field first, then left, then right
        return skew_join(left, right, field, "inner", hot_rows, hot)
    return left.join(right, field, "inner")


def count_rows(df: DataFrame, alias: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(alias))
