"""Erasure of single records from a large partitioned table.

Meaning (kept from the original job): a row is erased when its partition value
is one of the partitions named by the requests **and** its key is one of the
requested keys; partition and key are matched independently.  Null request
keys match nothing and rows with a null key are never erased (the raw
``NOT IN`` behaviour, where one null empties the answer, is ``not_in``).

Physical protocol (``erase_records`` for catalog tables, ``erase_records_path``
for file datasets) -- only touched partitions are read and rewritten,
untouched partitions keep their files:

1. the request list (key, partition) is written to the state folder under
   ``spark.checkpoint.dir``; from then on it cannot be lost
2. the requested partitions are worked through in batches of at most
   ``BATCH_PARTITIONS`` (fewer where a batch has too many files), so every
   swap holds at any size.  Per batch: the partitions' files are listed into a
   table (``file_lists``), the survivors are found in one pass, written in the
   table's own format to a hidden staging folder inside the table, re-read and
   counted
3. a marker is written, which names the tables of files to move and to delete
   (streamed when they are, however long), then the swap:

   * ``relocate`` (catalog tables, default): each partition is pointed at its
     staging folder (``ALTER TABLE .. SET LOCATION``, catalog only).  Readers by
     path skip hidden folders, so use another swap where there are such.
   * ``copy``: the staged files are renamed into the partition folders, all
     the old files go (the standard folder layout stays).
   * ``files``: as ``copy``, but only for the data files that hold a requested
     key; work is proportional to those files.

4. the rows now seen through the table in this batch's files are counted; only
   then are the listed old files deleted, one by one; touched partitions left
   without a data file are dropped.  Between the renames and the deletes a
   concurrent reader of ``copy`` and ``files`` may see survivors twice.

After a crash the next call, whatever its requests are, first ends what was
begun: a batch whose listed old files are unchanged is carried forward from
its marker; if any of them changed or is missing (rows were appended to a
relocated folder, a file was rewritten), the batch is rolled back and its
staging thrown away.  Then the stored request list is run again where it is not
proven complete, then the call's own.  Only files listed before staging are
ever deleted, so rows appended meanwhile survive.  A call holds the table's
lease (``lease``): a second one waits or refuses, and a call whose lease was
taken over stops at its next step.
"""

from __future__ import annotations

import dataclasses as dc
import hashlib
import json
import re
import uuid
from functools import reduce
from itertools import islice
from operator import and_

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera import fsutil
from tessera.functions.naming import quote_ident, sql_literal
from tessera.operators.file_lists import MOVES, FileLists, each, path_key, stream
from tessera.operators.lease import Busy, Lease
from tessera.operators.joins import (
    DEFAULT_BROADCAST_BYTES, DEFAULT_BROADCAST_ROWS, HOT_ROWS, broadcast_if_small, measure,
    size_checked, skew_join,
)
from tessera.session import stable_root
from tessera.sinks.writers import FILE_BYTES, cluster_for_write
from tessera.sources.catalog import (
    MAX_PARTITION_LITERALS, describe, partition_columns, partition_values,
)
from tessera.sources.files import FORMATS


def _request_parts(requests: DataFrame, req_part: str, part: str) -> DataFrame:
    return (requests.select(F.col(req_part).alias(part))
            .where(F.col(part).isNotNull()).distinct())


def _request_keys(requests: DataFrame, req_key: str, key: str) -> DataFrame:
    return (requests.select(F.col(req_key).alias(key))
            .where(F.col(key).isNotNull()).distinct())


def _plan_keys(keys_df: DataFrame, key: str, key_literals: int,
               broadcast_rows: int) -> tuple[DataFrame, int, bool, list | None]:
    """How the requested keys meet the table, decided by one measuring job:
    ``(keys, count, broadcast?, literal list or None)``.  At most
    ``key_literals`` keys become a literal ``IN`` list (collected only when
    the count proves it short); otherwise a join side, broadcast only when
    proven small in rows and bytes."""
    n, nbytes = measure(keys_df)
    if n <= key_literals:
        few = sorted(r[0] for r in keys_df.collect()) if n else []
        return keys_df, n, True, few
    small = n <= broadcast_rows and nbytes <= DEFAULT_BROADCAST_BYTES
    return (F.broadcast(keys_df) if small else keys_df), n, small, None


def _split_touched(main: DataFrame, parts_df: DataFrame, part: str) -> tuple[DataFrame, DataFrame]:
    """(touched, untouched) rows of ``main`` for the requested partitions.

    Up to 10 000 requested partitions become literals (static partition
    pruning, no join); beyond that the partition list is a checked-size
    broadcast side of a semi / anti join.
    """
    values = partition_values(parts_df, part)
    if values is not None:
        inside = F.col(part).isin(values) if values else F.lit(False)
        return main.where(inside), main.where(~inside | F.col(part).isNull())
    parts, _ = broadcast_if_small(parts_df)
    return (main.join(parts, part, "left_semi").select(*main.columns),
            main.join(parts, part, "left_anti").select(*main.columns))


# Up to this many requested keys are applied as a literal ``IN`` filter, which
# Spark pushes into the Parquet reader (row groups whose min/max or
# dictionary exclude every key are skipped); more keys go through a join.
MAX_KEY_LITERALS = 1000


def locate_records(main: DataFrame, requests: DataFrame, key: str, part: str,
                   req_key: str | None = None, req_part: str | None = None,
                   broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                   hot_rows: int = HOT_ROWS, key_literals: int = MAX_KEY_LITERALS) -> DataFrame:
    """Rows of ``main`` that the requests erase: the requested partitions
    only (pruned scan), then the requested keys -- as a pushed-down ``IN``
    filter for a short key list, else a semi join (broadcast when the key
    set is proven small, else a hot-key-salted shuffle join)."""
    touched, _ = _split_touched(main, _request_parts(requests, req_part or part, part), part)
    keys, _, small, few = _plan_keys(_request_keys(requests, req_key or key, key), key,
                                     key_literals, broadcast_rows)
    if few is not None:
        return touched.where(F.col(key).isin(few) if few else F.lit(False))
    if small:
        return touched.join(keys, key, "left_semi").select(*main.columns)
    return skew_join(touched, keys, key, "left_semi", hot_rows)


def erase_view(main: DataFrame, requests: DataFrame, key: str, part: str,
               req_key: str | None = None, req_part: str | None = None,
               broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
               hot_rows: int = HOT_ROWS, key_literals: int = MAX_KEY_LITERALS) -> DataFrame:
    """What is left of ``main`` (read-only form).  Untouched partitions pass
    through with no join at all; only touched partitions meet the key set."""
    touched, untouched = _split_touched(main, _request_parts(requests, req_part or part, part),
                                        part)
    keys, _, small, few = _plan_keys(_request_keys(requests, req_key or key, key), key,
                                     key_literals, broadcast_rows)
    if few is not None:
        kept = touched.where(~F.col(key).isin(few) | F.col(key).isNull()) if few else touched
        return untouched.unionByName(kept)
    if small:
        kept = touched.join(keys, key, "left_anti").select(*main.columns)
    else:
        kept = skew_join(touched, keys, key, "left_anti", hot_rows)
    return untouched.unionByName(kept)


def not_in(main: DataFrame, requests: DataFrame, key: str | list[str],
           req_key: str | list[str] | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Raw SQL ``key NOT IN (SELECT req_key FROM requests)``, for one column
    or several: ``(a, b) NOT IN (SELECT x, y ...)``.  Three-valued: a row
    stays only if it differs from every listed row in a column where both are
    known; an empty list keeps every row.

    Planned without the null-aware joins Spark forces (a broadcast of the
    list; for several columns a nested loop): two rows may be equal where
    neither has a null, so for each pattern of nulls in the list and in
    ``main`` the columns known on both sides are compared by an ordinary anti
    join, with hot keys of ``main`` split.  A pair of patterns without a
    common known column matches always.  One job lists the patterns of either
    side: at most 2 to the number of columns.
    """
    keys = [key] if isinstance(key, str) else list(key)
    asked = keys if req_key is None else [req_key] if isinstance(req_key, str) else list(req_key)
    if len(keys) != len(asked):
        raise ValueError(f"{len(keys)} columns are compared with {len(asked)}")
    listed = requests.select(*[F.col(a).alias(f"__k{i}") for i, a in enumerate(asked)])
    names = listed.columns

    def patterns(df: DataFrame, columns: list[str]) -> list[tuple]:
        return [tuple(r) for r in df.select(*[F.col(c).isNull() for c in columns]).distinct().collect()]

    def of(columns: list[str], pattern: tuple):
        known = [F.col(c).isNull() if null else F.col(c).isNotNull()
                 for c, null in zip(columns, pattern, strict=True)]
        return reduce(and_, known)

    theirs = patterns(listed, names)
    if not theirs:
        return main
    rows = main.withColumns(dict(zip(names, [F.col(k) for k in keys], strict=True)))
    out = main.where(F.lit(False))
    for mine in patterns(main, keys) if len(keys) > 1 else [(False,)]:
        left = rows.where(of(names, mine))
        for their in theirs:
            both = [n for n, a, b in zip(names, mine, their, strict=True) if not a and not b]
            if not both:                     # unknown in every column: equality can't be ruled out
                left = None
                break
            some = listed.where(of(names, their)).select(*both).distinct()
            left = skew_join(left, some, both, "left_anti", hot_rows)
        if left is not None:
            out = out.unionByName(left.select(*main.columns))
    return out


@dc.dataclass
class EraseReport:
    """``partitions``: the requested ones (None above
    ``MAX_PARTITION_LITERALS``); counts include a resumed earlier call."""
    table: str
    partitions: list | None
    touched_rows: int = 0
    erased_rows: int = 0
    kept_rows: int = 0
    emptied: list = dc.field(default_factory=list)
    resumed: bool = False
    skipped: bool = False

    def add(self, other: EraseReport) -> None:
        self.touched_rows += other.touched_rows
        self.erased_rows += other.erased_rows
        self.kept_rows += other.kept_rows
        self.emptied = sorted({*self.emptied, *other.emptied})


class SourceChanged(RuntimeError):
    """The files to replace are no longer those that were read."""


STEPS = ("requests", "staged", "half-swapped", "swapped", "verified", "half-deleted", "deleted",
         "unmarked")


class _Stop:
    """What is asked between steps: whether the lease is still this call's,
    and (test hook) whether to stop here, as a crash would."""

    lease: Lease | None = None

    def __init__(self, step: str | None):
        if step is not None and step not in STEPS:
            raise ValueError(f"unknown step {step!r}; expected one of {STEPS}")
        self.step = step

    def at(self, step: str) -> None:
        if self.lease is not None and not self.lease.holds():
            raise Busy(f"the lease was taken over before {step!r}")
        if step == self.step:
            raise RuntimeError(f"stopped at {step!r} (test hook)")


def _spec(part: str, value) -> str:
    return f"PARTITION ({quote_ident(part)} = {sql_literal(value)})"


class _Target:
    """What is erased from: reading it, its partition folders, its format."""

    def __init__(self, spark: SparkSession, name: str, root: str, part: str, fmt: str,
                 options: dict):
        if fmt not in FORMATS:
            raise ValueError(f"{name} is stored as {fmt!r}; an erase can rewrite {FORMATS}")
        self.spark, self.name, self.part, self.fmt = spark, name, part, fmt
        self.root, self.options = root.rstrip("/"), options

    def staged(self, schema: StructType, path: str) -> DataFrame:
        return self.spark.read.format(self.fmt).options(**self.options).schema(schema).load(path)

    def batch(self, values: list) -> DataFrame:
        main = self.read()
        kind = main.schema[self.part].dataType
        return main.where(F.col(self.part).isin([F.lit(v).cast(kind) for v in values]))

    def in_place(self, values: list, run: str, written: str) -> DataFrame:
        """Rows of the partitions that are seen in the files of an erase run:
        those carry its id in their name, or in their folder's and ``written``,
        the id of the job that staged them, in their own."""
        return self.batch(values).where(F.col("_metadata.file_path").rlike(
            f"/(_erase_{run}/.*{written}[^/]*|erase-{run}-[^/]*)$"))


class _Table(_Target):
    """A catalog table with one partition column."""

    def __init__(self, spark: SparkSession, table: str, part: str | None):
        columns = partition_columns(spark, table)
        if len(columns) != 1:
            raise ValueError(f"{table} must have exactly one partition column, has {columns}")
        if part not in (None, columns[0]):
            raise ValueError(f"{part} is not a partition column of {table}")
        facts = describe(spark, table)
        self.managed = facts["type"] == "MANAGED"
        create = spark.sql(f"SHOW CREATE TABLE {quote_ident(table)}").first()[0]
        block = re.search(r"(?s)\nOPTIONS \((.*?)\)\n(?:PARTITIONED|LOCATION|TBLPROP|COMMENT|$)", create)
        unquote = lambda t: re.sub(r"\\(.)", r"\1", t)
        options = {unquote(k): unquote(v) for k, v in re.findall(
            r"'((?:[^'\\]|\\.)*)' = '((?:[^'\\]|\\.)*)'", block[1] if block else "")}
        super().__init__(spark, table, facts["location"], columns[0],
                         (facts["provider"] or "").lower(), options)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def refresh(self) -> None:
        self.spark.catalog.refreshTable(self.name)

    def folders(self, values: list) -> dict[str, str]:
        """Folder of each of the values that is a partition (looked up one by
        one: the list of all partitions is never fetched)."""
        def look(v):
            spec = _spec(self.part, v)
            if self.spark.sql(f"SHOW PARTITIONS {quote_ident(self.name)} {spec}").isEmpty():
                return None
            return describe(self.spark, self.name, spec)["location"].rstrip("/")
        return {v: f for v, f in zip(values, each(look, values), strict=True) if f}

    def point(self, value, folder: str) -> None:
        self.spark.sql(f"ALTER TABLE {quote_ident(self.name)} {_spec(self.part, value)} "
                       f"SET LOCATION {sql_literal(folder)}")

    def drop(self, folders: dict[str, str], chunk: int = 500) -> None:
        specs = [_spec(self.part, v) for v in folders]
        for i in range(0, len(specs), chunk):
            self.spark.sql(f"ALTER TABLE {quote_ident(self.name)} DROP IF EXISTS "
                           + ", ".join(specs[i:i + chunk]))
        each(lambda f: fsutil.delete(self.spark, f), list(folders.values()))
        self.refresh()


class _Path(_Target):
    """A file dataset in ``part=value`` folders."""

    def __init__(self, spark: SparkSession, path: str, part: str, schema, fmt: str, options: dict):
        super().__init__(spark, path, path, part, fmt.lower(), options)
        self.schema = schema
        if part not in self.read().columns:
            raise ValueError(f"{part} is not a column of {path}")
        first = next(iter(self._all().values()), None)
        if first is None or any("=" in d.rsplit("/", 1)[-1] for d in fsutil.list_dirs(spark, first)):
            raise ValueError(f"{path} must be partitioned by {part} alone")

    def read(self) -> DataFrame:
        reader = self.spark.read.format(self.fmt).options(**self.options)
        return (reader.schema(self.schema) if self.schema is not None else reader).load(self.root)

    def refresh(self) -> None:
        self.spark.catalog.refreshByPath(self.root)

    def _all(self) -> dict[str, str]:
        found = {fsutil.partition_dir_value(f, self.part): f
                 for f in fsutil.list_dirs(self.spark, self.root)}
        return {v: f.rstrip("/") for v, f in found.items() if v is not None}

    def folders(self, values: list) -> dict[str, str]:
        have = self._all()
        return {v: have[str(v)] for v in values if str(v) in have}

    def drop(self, folders: dict[str, str]) -> None:
        each(lambda f: fsutil.delete(self.spark, f), list(folders.values()))
        self.refresh()


def _state_dir(spark: SparkSession, name: str) -> str:
    """State of a table's erase (request list, marker) under the checkpoint
    folder itself, so a restarted application ends an interrupted one."""
    safe = "".join(ch if ch.isalnum() or ch in "._-" else "_" for ch in name)
    digest = hashlib.sha1(name.encode()).hexdigest()[:8]
    return f"{stable_root(spark)}/tessera_erase_state/{safe[-80:]}-{digest}"


def _read_json(spark: SparkSession, path: str) -> dict | None:
    text = fsutil.read_text(spark, path)
    return json.loads(text) if text else None


def _stage_survivors(target: _Target, rows: DataFrame, columns: list[str], keys: DataFrame,
                     small: bool, few: list | None, key: str, staging: str, hot_rows: int,
                     files_per_partition: int | None, largest: int) -> dict:
    """One pass over ``rows``: tag requested keys, count, and write the
    survivors to ``staging`` in the target's format.

    The observed counts sit right before the write, in the final stage, so a
    retried map stage cannot count twice.  After a shuffled join the rows are
    clustered by partition again (``largest``, the bytes of the largest
    partition, gives the number of files), else each reducer would write a
    file for every partition.
    """
    obs = Observation()
    hit = F.col("__hit")
    flagged = keys.withColumn("__hit", F.lit(True))
    if few is not None:                        # short list: a literal IN, no join at all
        tagged = rows.withColumn("__hit", F.when(F.col(key).isin(few), F.lit(True)))
    elif small:                                # broadcast: no shuffle of the table
        tagged = rows.join(flagged, key, "left")
    else:                                      # shuffle: split hot keys (copies) first
        tagged = skew_join(rows, flagged, key, "left", hot_rows)
        files_per_partition = files_per_partition or max(1, -(-largest // FILE_BYTES))
    survivors = (cluster_for_write(tagged, target.part, files_per_partition)
                 .observe(obs, F.count(F.lit(1)).alias("rows"), F.count(hit).alias("erased"))
                 .where(hit.isNull()).select(*columns))
    (survivors.write.mode("overwrite").format(target.fmt).options(**target.options)
     .partitionBy(target.part).save(staging))
    m = obs.get
    return {"rows": int(m["rows"]), "erased": int(m["erased"]),
            "kept": int(m["rows"]) - int(m["erased"])}


def _check_staging(target: _Target, schema: StructType, staging: str, counts: dict) -> None:
    n = target.staged(schema, staging).count() if counts["kept"] else 0
    if n != counts["kept"]:
        raise RuntimeError(f"erase of {target.name}: staging holds {n} rows, expected "
                           f"{counts['kept']}")


def _forward(target: _Target, plan: dict, marker: str, stop: _Stop) -> None:
    """From a marker to the end of its batch.  Each step is skipped where it
    is already done; ``SourceChanged`` if the listed files are not those read."""
    spark = target.spark
    lists = FileLists(spark, plan["lists"])
    if plan["phase"] == "staged":
        half = plan["n_moves"] // 2
        if plan["swap"] == "relocate":
            live = target.folders([v for v, _, _ in plan["moves"]])
            moved = {v: new for v, _, new in plan["moves"] if live.get(v) == new}
            waiting = {v: old for v, old, _ in plan["moves"] if v not in moved}
            if {v: live.get(v) for v in waiting} != waiting or lists.changed("before", waiting):
                raise SourceChanged(f"partitions of {target.name} changed")

            def step(move):
                value, _, new = move
                if value not in moved:
                    target.point(value, new)
            moves = iter(plan["moves"])
        else:
            if lists.missing(plan["deletes"], plan["folders"]):
                raise SourceChanged(f"files of {target.name} changed")

            def step(move):
                src, dst = move
                if fsutil.exists(spark, src):
                    if not fsutil.rename(spark, src, dst):
                        raise OSError(f"could not move {src} to {dst}")
                elif not fsutil.exists(spark, dst):
                    raise SourceChanged(f"staged file {src} is gone")
            moves = lists.rows("moves")
        stream(step, islice(moves, half))
        stop.at("half-swapped")
        stream(step, moves)
        stop.at("swapped")
        target.refresh()
        if lists.missing(plan["deletes"], plan["folders"]):
            raise SourceChanged(f"files of {target.name} changed")
        seen = target.in_place(plan["values"], plan["run"], plan["written"]).count() if plan["kept"] else 0
        if seen != plan["kept"]:
            raise RuntimeError(f"erase of {target.name}: {seen} rows in place, expected "
                               f"{plan['kept']}; nothing was deleted, staging {plan['staging']}")
        plan["phase"] = "verified"
        fsutil.write_text(spark, marker, json.dumps(plan))
        stop.at("verified")
    gone = lists.rows(plan["deletes"])
    stream(lambda f: fsutil.delete(spark, f.path), islice(gone, plan["n_deletes"] // 2))
    stop.at("half-deleted")
    stream(lambda f: fsutil.delete(spark, f.path), gone)
    target.refresh()
    live = target.folders(plan["values"])
    empty = {v: f for v, f in live.items() if not fsutil.has_files(spark, f)}
    if empty:
        target.drop(empty)
    plan["emptied"] = sorted(str(v) for v in empty)
    if plan["swap"] == "relocate":
        for _, old, _ in plan["moves"]:
            if not fsutil.has_files(spark, old):
                fsutil.delete(spark, old)
                parent = old.rsplit("/", 1)[0]      # an earlier run's staging
                if "/_erase_" in parent and not fsutil.list_dirs(spark, parent):
                    fsutil.delete(spark, parent)
    stop.at("deleted")


def _roll_back(target: _Target, plan: dict) -> None:
    """Undo a batch that was not verified: files moved in go, partitions
    already re-pointed stay (each is whole by itself), the rest of the staging
    goes."""
    spark = target.spark
    lists = FileLists(spark, plan["lists"])
    if plan["swap"] == "relocate":
        live = target.folders([v for v, _, _ in plan["moves"]])
        changed = lists.changed("before", {v: old for v, old, new in plan["moves"]
                                           if live.get(v) == new})
        for value, old, new in plan["moves"]:
            if live.get(value) != new:
                fsutil.delete(spark, new)
            elif str(value) not in changed:
                fsutil.delete(spark, old)
            else:                        # rows came to the old folder: it is the one to keep
                target.point(value, old)
                fsutil.delete(spark, new)
        if not fsutil.list_dirs(spark, plan["staging"]):
            fsutil.delete(spark, plan["staging"])
    else:
        stream(lambda m: fsutil.delete(spark, m.dst), lists.rows("moves"))
        fsutil.delete(spark, plan["staging"])
    target.refresh()


def _finish(target: _Target, plan: dict, marker: str, stop: _Stop) -> None:
    """The marker goes first: staging without a marker is only litter."""
    fsutil.delete(target.spark, marker)
    fsutil.delete(target.spark, plan["lists"])
    stop.at("unmarked")
    if plan["swap"] != "relocate" or not plan["moves"]:
        fsutil.delete(target.spark, plan["staging"])


BATCH_PARTITIONS = 1000          # requested partitions of one staging and swap
MAX_AFFECTED_FILES = 100_000     # files of a batch of several partitions; one with more is halved
MAX_FILE_LITERALS = 1000         # files by whose names a scan is pruned; more go through a join


@dc.dataclass
class _Options:
    swap: str
    broadcast_rows: int
    hot_rows: int
    key_literals: int
    files_per_partition: int | None
    stop: _Stop
    wait: float = 0.0


def _erase_batch(target: _Target, key: str, wanted: list, keys: tuple, state: str, o: _Options,
                 last: bool) -> EraseReport:
    """Stage and swap the partitions ``wanted`` (at most a batch)."""
    spark, part = target.spark, target.part
    report = EraseReport(target.name, None)
    folders = target.folders(wanted)
    if not folders:
        return report
    run = uuid.uuid4().hex[:12]
    lists = FileLists(spark, f"{state}/lists_{run}")
    files = lists.list("before", folders)
    if len(folders) > 1 and files > MAX_AFFECTED_FILES:
        fsutil.delete(spark, lists.root)
        values, half = list(folders), len(folders) // 2
        report.add(_erase_batch(target, key, values[:half], keys, state, o, False))
        report.add(_erase_batch(target, key, values[half:], keys, state, o, last))
        return report
    keys_df, small, few = keys
    values = list(folders)
    rows = target.batch(values)
    columns, schema = rows.columns, rows.schema
    before = lists.read("before")
    total = n_deletes = None
    if o.swap == "files":
        with_file = rows.withColumn("__file", path_key(F.col("_metadata.file_path"), uri=True))
        if few is not None:
            hits = with_file.where(F.col(key).isin(few))
        elif small:
            hits = with_file.join(keys_df, key, "left_semi")
        else:
            hits = skew_join(with_file.select(key, "__file"), keys_df, key, "left_semi", o.hot_rows)
        held = lists.write_frame("held", hits.select("__file").distinct())
        if not held:
            fsutil.delete(spark, lists.root)
            return report
        hit = lists.read("held")
        n_deletes = lists.write_frame("deletes", before.withColumn("__file", path_key(F.col("path")))
                                      .join(hit, "__file", "left_semi").drop("__file"))
        if n_deletes != held:
            raise SourceChanged(f"files of {target.name} changed while they were read")
        total = rows.count()
        if held <= MAX_FILE_LITERALS:              # few files: the listing is pruned to them
            names = [r[0].rsplit("/", 1)[-1] for r in lists.read("deletes").select("path").collect()]
            rows = rows.where(F.col("_metadata.file_name").isin(names))
            rows = rows.withColumn("__file", path_key(F.col("_metadata.file_path"), uri=True))
            rows = rows.join(F.broadcast(hit), "__file", "left_semi").drop("__file")
        else:
            side, _, small_side = size_checked(hit)
            rows = (with_file.join(side, "__file", "left_semi") if small_side
                    else skew_join(with_file, hit, "__file", "left_semi", o.hot_rows)).drop("__file")
    deletes, n_deletes = ("deletes", n_deletes) if o.swap == "files" else ("before", files)
    staging = f"{target.root}/_erase_{run}"
    fsutil.write_text(spark, state + "/_pending", staging)
    largest = before.groupBy("value").agg(F.sum("size").alias("b")).agg(F.max("b")).first()[0] or 0
    counts = _stage_survivors(target, rows, columns, keys_df, small, few, key, staging, o.hot_rows,
                              o.files_per_partition, largest)
    _check_staging(target, schema, staging, counts)
    if counts["erased"] == 0:                  # nothing to erase here: leave it as it is
        fsutil.delete(spark, staging)
        fsutil.delete(spark, lists.root)
        report.touched_rows = report.kept_rows = counts["rows"] if total is None else total
        return report
    by_text = {str(v): v for v in values}
    staged = {by_text[fsutil.partition_dir_value(f, part)]: f.rstrip("/")
              for f in fsutil.list_dirs(spark, staging)
              if fsutil.partition_dir_value(f, part) is not None}
    moves = [[v, folders[v], f] for v, f in staged.items()] if o.swap == "relocate" else []
    n_moves = len(moves)
    first = next((f for v in staged.values() for f, _, _ in fsutil.iter_files(spark, v)), "")
    written = re.search(r"/part-\d+-([0-9a-f-]{36})", first)
    if o.swap != "relocate":
        n_moves = lists.write("moves", (
            (src, f"{folders[v]}/erase-{run}-{src.rsplit('/', 1)[-1]}")
            for v, folder in staged.items() for src, _, _ in fsutil.iter_files(spark, folder)), MOVES)
    plan = {"swap": o.swap, "phase": "staged", "staging": staging, "run": run, "last": last,
            "lists": lists.root, "values": values, "folders": {str(v): f for v, f in folders.items()},
            "moves": moves, "n_moves": n_moves, "deletes": deletes,
            "n_deletes": n_deletes, "kept": counts["kept"],
            "emptied": [], "written": written[1] if written else "",
            "touched_rows": counts["rows"] if total is None else total,
            "erased_rows": counts["erased"]}
    plan = json.loads(json.dumps(plan, default=str))
    marker = state + "/_marker"
    fsutil.write_text(spark, marker, json.dumps(plan))
    o.stop.at("staged")
    _forward(target, plan, marker, o.stop)
    _finish(target, plan, marker, o.stop)
    report.touched_rows, report.erased_rows = plan["touched_rows"], plan["erased_rows"]
    report.kept_rows = plan["touched_rows"] - plan["erased_rows"]
    report.emptied = plan["emptied"]
    return report


def _run_requests(target: _Target, stored: DataFrame, key: str, state: str,
                  o: _Options) -> EraseReport:
    """The stored request list over all its partitions, batch by batch."""
    part = target.part
    keys_df, n, small, few = _plan_keys(_request_keys(stored, key, key), key, o.key_literals,
                                        o.broadcast_rows)
    report = EraseReport(target.name, [])
    if n:
        kind = target.read().schema[part].dataType
        wanted = (stored.select(F.col(part).cast(kind).alias(part)).where(F.col(part).isNotNull())
                  .distinct().select(F.col(part).cast("string").alias(part)).orderBy(part))
        batch: list = []
        seen: list | None = []
        for row in wanted.toLocalIterator(prefetchPartitions=True):
            if len(batch) == BATCH_PARTITIONS:
                report.add(_erase_batch(target, key, batch, (keys_df, small, few), state, o, False))
                batch = []
            batch.append(row[0])
            if seen is not None:
                seen = None if len(seen) == MAX_PARTITION_LITERALS else seen
            if seen is not None:
                seen.append(row[0])
        if batch:
            report.add(_erase_batch(target, key, batch, (keys_df, small, few), state, o, True))
        report.partitions = seen
    report.skipped = not n or report.partitions == []
    return report


def _erase(target: _Target, requests: DataFrame, key: str, req_key: str | None,
           req_part: str | None, state: str, o: _Options) -> EraseReport:
    """``_erase_held`` under the table's lease: a call that is still running is
    never taken for one that died."""
    with Lease(target.spark, state + ".lease", o.wait) as lease:
        o.stop.lease = lease
        return _erase_held(target, requests, key, req_key, req_part, state, o)


def _erase_held(target: _Target, requests: DataFrame, key: str, req_key: str | None,
                req_part: str | None, state: str, o: _Options) -> EraseReport:
    spark, part = target.spark, target.part
    marker, begun = state + "/_marker", state + "/_begun"
    earlier = _read_json(spark, begun)
    resumed = EraseReport(target.name, [])
    if earlier is not None:
        plan = _read_json(spark, marker)
        complete = False
        if plan is not None:
            try:
                _forward(target, plan, marker, o.stop)
                complete = plan["last"]
                resumed.add(EraseReport(target.name, None, plan["touched_rows"],
                                        plan["erased_rows"],
                                        plan["touched_rows"] - plan["erased_rows"],
                                        plan["emptied"]))
            except SourceChanged:
                _roll_back(target, plan)
            _finish(target, plan, marker, o.stop)
        else:                                  # staging that never got its marker
            pending = fsutil.read_text(spark, state + "/_pending")
            if pending:
                _drop_litter(target, pending)
        if not complete:
            stored = spark.read.parquet(earlier["requests"])
            resumed.add(_run_requests(target, stored, earlier["key"], state, o))
    fsutil.delete(spark, state)
    path = f"{state}/requests_{uuid.uuid4().hex[:12]}"
    (requests.select(F.col(req_key or key).alias(key), F.col(req_part or part).alias(part))
     .write.parquet(path))
    fsutil.write_text(spark, begun, json.dumps({"requests": path, "key": key}))
    o.stop.at("requests")
    report = _run_requests(target, spark.read.parquet(path), key, state, o)
    fsutil.delete(spark, state)
    report.add(resumed)
    report.resumed = earlier is not None
    return report


def _drop_litter(target: _Target, staging: str) -> None:
    """Remove a staging folder without a marker; partitions that a finished
    relocation points into it stay."""
    spark = target.spark
    found = {fsutil.partition_dir_value(f, target.part): f.rstrip("/")
             for f in fsutil.list_dirs(spark, staging)}
    values = [v for v in found if v is not None]
    live = set(target.folders(values).values()) & set(found.values()) if values else set()
    for folder in found.values():
        if folder not in live:
            fsutil.delete(spark, folder)
    if not live:
        fsutil.delete(spark, staging)


def erase_records(spark: SparkSession, table: str, requests: DataFrame, key: str,
                  part: str | None = None, req_key: str | None = None,
                  req_part: str | None = None, *, swap: str = "relocate",
                  broadcast_rows: int = DEFAULT_BROADCAST_ROWS, hot_rows: int = HOT_ROWS,
                  key_literals: int = MAX_KEY_LITERALS,
                  files_per_partition: int | None = None,
                  fail_after_staging: bool = False, stop_at: str | None = None,
                  wait: float = 0.0) -> EraseReport:
    """Erase requested records from catalog table ``table`` in place.

    ``requests`` holds ``req_key`` (default ``key``) and ``req_part`` (default
    the table's partition column).  ``swap`` is ``relocate``, ``copy`` or
    ``files`` (see the module notes).  The table has exactly one partition
    column and one of the file formats of this library; anything else raises
    before any work.  ``files_per_partition`` bounds the files each rewritten
    partition gets (and spreads a hot partition over that many writer tasks).
    When the key set is too large to broadcast, keys with more than
    ``hot_rows`` rows in the table (many copies of one record) are salted over
    several tasks.  While another call works on the table this one waits up to
    ``wait`` seconds, then raises ``lease.Busy``; the lease of a call that died
    expires (``lease.LEASE_SECONDS``).  ``stop_at`` is a test hook that stops at one of ``STEPS``,
    like a crash would (``fail_after_staging``: at ``staged``).
    """
    if swap not in ("relocate", "copy", "files"):
        raise ValueError("swap must be 'relocate', 'copy' or 'files'")
    target = _Table(spark, table, part)
    stop = _Stop("staged" if fail_after_staging else stop_at)
    return _erase(target, requests, key, req_key, req_part, _state_dir(spark, table),
                  _Options(swap, broadcast_rows, hot_rows, key_literals, files_per_partition, stop, wait))


def erase_records_path(spark: SparkSession, path: str, requests: DataFrame, key: str,
                       part: str, req_key: str | None = None, req_part: str | None = None, *,
                       schema: StructType | None = None, fmt: str = "parquet",
                       options: dict | None = None, swap: str = "copy",
                       broadcast_rows: int = DEFAULT_BROADCAST_ROWS, hot_rows: int = HOT_ROWS,
                       key_literals: int = MAX_KEY_LITERALS,
                       files_per_partition: int | None = None,
                       fail_after_staging: bool = False, stop_at: str | None = None,
                       wait: float = 0.0) -> EraseReport:
    """``erase_records`` for a file dataset in ``part=value`` folders, without a
    catalog; swap ``copy`` or ``files``.  ``options`` are those the files are
    read and written with.  Pass ``schema`` (with ``part`` in it) to keep the
    partition column's type: folder names are otherwise re-inferred (``'007'``
    would become 7)."""
    if swap not in ("copy", "files"):
        raise ValueError("swap must be 'copy' or 'files'")
    target = _Path(spark, path, part, schema, fmt, options or {})
    stop = _Stop("staged" if fail_after_staging else stop_at)
    return _erase(target, requests, key, req_key, req_part, _state_dir(spark, "path:" + path),
                  _Options(swap, broadcast_rows, hot_rows, key_literals, files_per_partition, stop, wait))
