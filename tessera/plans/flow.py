"""Stage flows: ``"GROUP:NIN, JOIN:ADDRESS, CUBE:NIN, WRITE:"``.

Semantics kept from the original job: a step that names a field (``GROUP:x``,
``JOIN:x``, ``CUBE:x``) always starts from the **base** frame, so steps fan
out from the base; a bare step (``WRITE:``) gets the **last result** (the
base when nothing ran before it).  ``WRITE:x`` writes the base.  Step names
are case-insensitive; blanks are ignored.

Each shuffle step is executed on its own, so that its shuffle can be measured:
stored where the next step writes its result, else into a ``noop`` sink (the
full plan runs, nothing is stored).  Real chaining of steps is plain Python
composition of the operator functions.
"""

from __future__ import annotations

import dataclasses as dc
import time
from collections.abc import Callable

from pyspark.sql import DataFrame

from tessera.operators.joins import HOT_ROWS, copy_with_hot_keys
from tessera.operators.stages import cube_avg_max, group_sum, join_inner_using, rename_columns
from tessera.session import scratch_path

# The step names of the original flow text.
STEP_NAMES = ("GROUP", "JOIN", "CUBE", "WRITE")

# The 17 column names the original JOIN stage gives the joined
# records (9 + 9 columns, one shared key), in order and spelling.
JOIN_NAMES = ("newCol1", "newCol2", "newCol3", "newCol4", "newCol5", "newCol6", "newCol7",
              "newCol8", "newCol9", "newCol10", "newCol11", "newCol12", "newCol13", "newCol14",
              "newCol15", "newcol16", "newcol17")


@dc.dataclass(frozen=True)
class Step:
    name: str
    field: str | None = None


@dc.dataclass(frozen=True)
class FlowSpec:
    """Columns the steps use (the original hard-wired BENEFITS/ADDRESS/BALANCE)."""

    value_col: str = "BENEFITS"        # GROUP sums it, CUBE averages it
    second_col: str = "ADDRESS"        # CUBE's second dimension
    max_col: str = "BALANCE"           # CUBE's max
    group_alias: str | None = None
    exact_decimal: str | None = None   # e.g. "decimal(18,2)" for order-free sums
    right_prefix: str | None = "r_"    # JOIN: prefix clashing right columns
    join_names: tuple[str, ...] | None = None   # JOIN: optional positional rename
    hot_rows: int | None = HOT_ROWS    # JOIN: split keys with more rows over several tasks
    avg_digits: int | None = None      # CUBE: round the average (order-free comparisons)


@dc.dataclass
class FlowResult:
    last: DataFrame
    timings: list[tuple[str, float]]


def parse_flow(text: str) -> list[Step]:
    steps = []
    for token in "".join(text.split()).split(","):
        if not token:
            continue
        name, _, field = token.partition(":")
        name = name.upper()
        if name not in STEP_NAMES:
            raise ValueError(f"unknown stage {name!r} in flow {text!r}; expected {STEP_NAMES}")
        if name != "WRITE" and not field:
            raise ValueError(f"stage {name} needs a field, e.g. {name}:col")
        steps.append(Step(name, field or None))
    return steps


def step_frame(step: Step, base: DataFrame, other: DataFrame | None, spec: FlowSpec,
               hot: DataFrame | None = None) -> DataFrame:
    """The DataFrame one shuffle step produces from the base (``hot``: the
    base's hot join keys, where they are known)."""
    if step.name == "GROUP":
        return group_sum(base, step.field, spec.value_col, spec.group_alias, spec.exact_decimal)
    if step.name == "JOIN":
        if other is None:
            raise ValueError("JOIN needs a second input")
        out = join_inner_using(base, other, step.field, spec.right_prefix, spec.hot_rows, hot)
        return rename_columns(out, spec.join_names) if spec.join_names else out
    if step.name == "CUBE":
        return cube_avg_max(base, step.field, spec.second_col, spec.value_col, spec.max_col,
                            avg_digits=spec.avg_digits)
    raise ValueError(step.name)


def _storable(df: DataFrame) -> bool:
    """Whether parquet can hold ``df``: no column name twice, no typeless column."""
    names = {c.lower() for c in df.columns}
    return len(names) == len(df.columns) and all(
        t not in df.schema.simpleString() for t in ("void", "interval", "variant"))


def run_flow(base: DataFrame, other: DataFrame | None, flow: str | list[Step],
             write: Callable[[DataFrame], None] | None = None, spec: FlowSpec = FlowSpec(),
             execute: bool = True) -> FlowResult:
    """Run the steps in order.  A base that several shuffle steps or a join
    would evaluate again is written once under ``spark.checkpoint.dir``; the
    same job finds the hot keys of the joins.  A second input that several
    joins read is written once too, and so is the result of a step that a bare
    WRITE follows: the step runs once, WRITE reads what it stored."""
    steps = parse_flow(flow) if isinstance(flow, str) else flow
    shuffles = [s for s in steps if s.name != "WRITE"]
    joins = sorted({s.field for s in shuffles if s.name == "JOIN"})
    hot: dict[str, DataFrame | None] = {}
    if execute and len(shuffles) > 1 or joins and spec.hot_rows:
        base, hot = copy_with_hot_keys(base, joins if spec.hot_rows else [],
                                       scratch_path(base.sparkSession, "flow-base"),
                                       spec.hot_rows or HOT_ROWS)
    if execute and other is not None and sum(s.name == "JOIN" for s in shuffles) > 1:
        other, _ = copy_with_hot_keys(other, [], scratch_path(other.sparkSession, "flow-other"))
    last = base
    timings: list[tuple[str, float]] = []
    for step, after in zip(steps, [*steps[1:], None], strict=True):
        t0 = time.perf_counter()
        if step.name == "WRITE":
            target = base if step.field else last
            if write is None:
                raise ValueError("flow has WRITE but no writer was given")
            write(target)
            last = target
        else:
            last = step_frame(step, base, other, spec, hot.get(step.field))
            if execute and after == Step("WRITE") and _storable(last):
                last, _ = copy_with_hot_keys(last, [], scratch_path(last.sparkSession, "flow-step"))
            elif execute:
                last.write.format("noop").mode("overwrite").save()
        timings.append((f"{step.name}:{step.field or ''}", time.perf_counter() - t0))
    return FlowResult(last, timings)
