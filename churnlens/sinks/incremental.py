"""Incremental loads of a keyed table: only the parts that change are written.

A table is cut into parts by an expression over its key, so a key never moves.
Each load is a version directory beside the earlier ones::

    base/v=000000000000001-ab12cd34/__layout=full-<definition>/__part=0/...
    base/v=000000000000002-ef56ab78/__layout=load-<definition>/__part=7/...

and holds the whole new content of the parts that it changed, in files that
Spark wrote and committed (``_SUCCESS``). A part's content is that of the
newest committed version that has it, looking back to the last full one. So a
load is atomic, untouched parts are neither read nor written, a load that
dies leaves nothing that is read, and earlier versions stay readable until
:func:`vacuum_keyed` is asked to delete them. Listings decide all of it; there
is no log to keep.

Writers take turns: a load that finds another one's version after its own
write withdraws its version and raises.
"""

from __future__ import annotations

import time
import uuid
import zlib
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlens.operators.changes import (
    DIGEST,
    INSERT,
    UNCHANGED,
    UPDATE,
    detect_changes,
    one_per_key,
    same_key,
    with_digest,
)
from churnlens.operators.conform import conform
from churnlens.sinks.publish import SUCCESS_MARKER, VERSION_PREFIX, committed_versions, _new_version_name
from churnlens.sinks.storage import children_changed, delete_path, join_path, list_children

LAYOUT, PART = "__layout", "__part"
FULL, LOAD = "full", "load"
WORK_PREFIX = "_load-"


@dataclass(frozen=True)
class KeyedTable:
    """Where a table lies, its columns, its key, and how the key deals rows into parts.

    ``part_by`` is SQL over the key columns that gives a whole number (a range
    of ids, a month, ``pmod(xxhash64(id), 256)``); rows for which it is NULL
    form the part -1. Loads rewrite whole parts, so the more local changes are
    in it, the less is written. ``ignored`` columns, such as load times, do
    not make a row changed.
    """

    base: str
    schema: T.StructType
    keys: tuple[str, ...]
    part_by: str
    ignored: tuple[str, ...] = ()
    definition: str = field(init=False)

    def __post_init__(self):
        missing = [c for c in (*self.keys, *self.ignored) if c not in self.schema.names]
        if missing or not self.keys:
            raise ValueError(f"not columns of the table: {missing}" if missing else "a keyed table needs a key")
        text = "\n".join([*self.keys, self.part_by, *self.ignored])
        object.__setattr__(self, "definition", f"{zlib.crc32(text.encode()):08x}")

    @property
    def stored(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField(DIGEST, T.LongType())])

    def part(self) -> Column:
        return F.coalesce(F.expr(self.part_by).cast("long"), F.lit(-1).cast("long"))


@dataclass(frozen=True)
class LoadResult:
    version: str | None  # None: nothing changed, nothing was written
    inserted: int
    updated: int
    unchanged: int
    parts: tuple[int, ...]  # rewritten

    @property
    def rows(self) -> int:
        return self.inserted + self.updated + self.unchanged


def _parts_of(spark: SparkSession, table: KeyedTable, version: str) -> tuple[bool, dict[int, str]]:
    """Whether a version is a full one, and its part directories."""
    top = join_path(table.base, version)
    names = [n for n in list_children(spark, top) if n.startswith(f"{LAYOUT}=")]
    if not names:
        return True, {}  # a full refresh with an empty table
    kind, definition = names[0][len(LAYOUT) + 1 :].split("-")
    if len(names) > 1 or definition != table.definition:
        raise ValueError(f"{top} was written with another key or partitioning: {names}")
    inside = join_path(top, names[0])
    return kind == FULL, {p: join_path(inside, f"{PART}={p}") for p in _part_numbers(spark, inside)}


def part_paths(spark: SparkSession, table: KeyedTable, version: str | None = None) -> dict[int, str]:
    """The directory of each part as of a committed version (default: the newest)."""
    versions = committed_versions(spark, table.base)
    if version is not None and version not in versions:
        raise FileNotFoundError(f"no committed version {version} at {table.base}")
    if not versions:
        raise FileNotFoundError(f"no published table at {table.base}")
    found: dict[int, str] = {}
    for name in reversed(versions[: versions.index(version) + 1] if version else versions):
        full, parts = _parts_of(spark, table, name)
        found = parts | found
        if full:
            break
    return found


def _stored(spark: SparkSession, table: KeyedTable, paths: Sequence[str]) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], table.stored)
    return spark.read.schema(table.stored).parquet(*paths)


def read_keyed(spark: SparkSession, table: KeyedTable, version: str | None = None) -> DataFrame:
    """The table, as it is now or as of a committed version; ``FileNotFoundError`` when never loaded."""
    return _stored(spark, table, list(part_paths(spark, table, version).values())).select(*table.schema.names)


def _write_version(rows: DataFrame, table: KeyedTable, kind: str) -> str:
    """Commit ``rows`` as the newest version; returns its name. A part is one or a few files, whoever had its rows."""
    name = _new_version_name(rows.sparkSession, table.base)
    dealt = rows.withColumn(LAYOUT, F.lit(f"{kind}-{table.definition}")).hint("rebalance", PART)
    dealt.write.mode("errorifexists").partitionBy(LAYOUT, PART).parquet(join_path(table.base, name))
    return name


def _only_writer(spark: SparkSession, table: KeyedTable, seen: Sequence[str], own: str) -> None:
    """Withdraw ``own`` and raise if anybody else committed a version since ``seen`` was listed."""
    others = [v for v in committed_versions(spark, table.base) if v != own and v not in seen]
    if others:
        delete_path(spark, join_path(join_path(table.base, own), SUCCESS_MARKER))
        raise RuntimeError(f"{own} at {table.base} was withdrawn: {', '.join(others)} came in between; load again")


def _keyed_rows(df: DataFrame, table: KeyedTable, newest_by: Sequence[str]) -> DataFrame:
    rows = one_per_key(conform(df, table.schema), table.keys, newest_by, table.ignored)
    return with_digest(rows, table.keys, table.ignored).withColumn(PART, table.part())


def refresh_keyed(df: DataFrame, table: KeyedTable, newest_by: Sequence[str] = ()) -> tuple[str, int]:
    """Replace the whole table; returns the version and its rows. Keys as in :func:`load_incremental`."""
    spark = df.sparkSession
    seen = committed_versions(spark, table.base)
    obs = Observation("refresh")
    rows = _keyed_rows(df, table, newest_by).observe(obs, F.count(F.lit(1)).alias("rows"))
    name = _write_version(rows, table, FULL)
    _only_writer(spark, table, seen, name)
    return name, int(obs.get["rows"])


def load_incremental(df: DataFrame, table: KeyedTable, newest_by: Sequence[str] = ()) -> LoadResult:
    """Insert the rows with new keys, replace those that differ, leave the rest.

    Of several rows of one key the largest ``newest_by`` counts; without it,
    rows of one key that differ fail the load. Keys that ``df`` lacks stay. A
    table that was never loaded takes all rows. Of the stored table, keys and
    digests are read in the parts that ``df`` has keys of, and whole rows in
    the parts that change; only these are written.
    """
    spark = df.sparkSession
    seen = committed_versions(spark, table.base)
    work = join_path(table.base, f"{WORK_PREFIX}{uuid.uuid4().hex}")
    incoming_path, changed_path = join_path(work, "incoming"), join_path(work, "changed")
    try:
        # written once, so its source is read only once; only versions have a folder for each part
        layout = T.StructType([*table.stored.fields, T.StructField(PART, T.LongType())])
        _keyed_rows(df, table, newest_by).write.parquet(incoming_path)
        incoming = spark.read.schema(layout).parquet(incoming_path)
        own_parts = _parts_in(incoming)
        paths = part_paths(spark, table) if seen else {}
        near = [paths[p] for p in own_parts if p in paths]
        marked = detect_changes(_stored(spark, table, near), incoming, table.keys, table.ignored)
        obs = Observation("changes")
        counts = [F.count_if(F.col("change") == c).alias(c) for c in (INSERT, UPDATE, UNCHANGED)]
        observed = marked.observe(obs, *counts).filter(F.col("change") != UNCHANGED).drop("change")
        observed.write.parquet(changed_path)
        found = {k: int(v) for k, v in obs.get.items()}
        changed = spark.read.schema(layout).parquet(changed_path)
        parts = tuple(_parts_in(changed))
        name = None
        if parts or not seen:
            old = _stored(spark, table, [paths[p] for p in parts if p in paths]).withColumn(PART, table.part())
            kept = old.alias("o").join(changed.alias("c"), same_key("o", "c", table.keys), "left_anti")
            name = _write_version(kept.unionByName(changed), table, LOAD if seen else FULL)
            _only_writer(spark, table, seen, name)
        return LoadResult(name, found[INSERT], found[UPDATE], found[UNCHANGED], parts)
    finally:
        delete_path(spark, work)


def _parts_in(rows: DataFrame) -> list[int]:
    """The parts that some rows lie in: their numbers alone, as a listing of the table gives them."""
    return sorted(r[0] for r in rows.select(PART).distinct().collect())


def _part_numbers(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n[len(PART) + 1 :]) for n in list_children(spark, path) if n.startswith(f"{PART}="))


def vacuum_keyed(spark: SparkSession, table: KeyedTable, older_than: float) -> list[str]:
    """Delete versions that no part of the current table lies in, and work folders left by
    loads that died, last changed over ``older_than`` seconds ago; returns their names.
    Choose ``older_than`` above the longest run of a reader or a load."""
    versions = committed_versions(spark, table.base)
    if not versions:
        return []
    needed = {versions[-1]} | {p[len(table.base.rstrip("/")) + 1 :].split("/")[0] for p in part_paths(spark, table).values()}
    changed, limit = children_changed(spark, table.base), time.time() - older_than
    old = [
        n
        for n in sorted(changed)
        if changed[n] < limit and n not in needed and (n.startswith(WORK_PREFIX) or (n.startswith(VERSION_PREFIX) and n < versions[-1]))
    ]
    # a full version ends the look back, so what lies before it goes first
    for name in old:
        delete_path(spark, join_path(table.base, name))
    return old
