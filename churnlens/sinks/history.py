"""Compaction of an append-only history: many small files become a few.

Every job run appends a small file. :func:`compact_history` packs the small
ones into bins of about a target size and writes the bins as a new version
beside the history (``<path>/_compacted/v=...``, which readers of the folder
do not see; a file a bin), together with the names of the files that they replace; files
that are large enough are left where they are. :func:`read_history` reads
what is not replaced, so a run that appends meanwhile is never lost and no
row is read twice. The files that were replaced stay until
:func:`vacuum_history` is asked to delete them.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlens.sinks.publish import SUCCESS_MARKER, _new_version_name, committed_versions
from churnlens.sinks.storage import children_changed, children_sizes, delete_path, join_path, list_children, path_exists

COMPACTED = "_compacted"
KIND, FILE, BIN = "__kind", "__file", "__bin"
ROWS, COVERED = "rows", "covered"

#: Size of a bin, and the share of it below which a file is worth moving.
TARGET_BYTES = 128 << 20
SMALL = 0.5


def pack_files(sizes: dict[str, int], target: int) -> list[list[str]]:
    """First fit, largest file first: bins of at most ``target`` bytes (a larger file is a bin of its own)."""
    bins: list[list[str]] = []
    room: list[int] = []
    for name in sorted(sizes, key=lambda n: (-sizes[n], n)):
        at = next((i for i, r in enumerate(room) if r >= sizes[name]), None)
        if at is None:
            bins.append([])
            room.append(target)
            at = len(bins) - 1
        bins[at].append(name)
        room[at] -= sizes[name]
    return bins


def _versions(spark: SparkSession, path: str) -> list[str]:
    base = join_path(path, COMPACTED)
    return [join_path(base, v) for v in committed_versions(spark, base)]


def _replaced(spark: SparkSession, versions: list[str]) -> set[str]:
    """Names of the files that some versions replace (a name a run)."""
    paths = [p for v in versions if path_exists(spark, p := join_path(v, f"{KIND}={COVERED}"))]
    if not paths:
        return set()
    names = spark.read.schema(f"{FILE} string").option("recursiveFileLookup", True).parquet(*paths)
    return {r[FILE] for r in names.collect()}


def _folders(spark: SparkSession, path: str, versions: list[str]) -> list[str]:
    """Where data files lie: the history's folder, and one per bin."""
    tops = [join_path(v, f"{KIND}={ROWS}") for v in versions]
    return [path, *[join_path(top, n) for top in tops for n in list_children(spark, top)]]


def live_files(spark: SparkSession, path: str) -> dict[str, int]:
    """The files that hold the history's rows, each row once, and their sizes in bytes."""
    versions = _versions(spark, path)
    gone = _replaced(spark, versions)
    return {
        join_path(folder, name): size
        for folder in _folders(spark, path, versions)
        for name, size in sorted(children_sizes(spark, folder).items())
        if name.endswith(".parquet") and name not in gone
    }


def read_history(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows of an append-only history, compacted or not; ``FileNotFoundError`` when absent."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no history at {path}")
    if not _versions(spark, path):
        return spark.read.schema(schema).parquet(path)
    files = list(live_files(spark, path))
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)


def compact_history(spark: SparkSession, path: str, schema: T.StructType, target_bytes: int = TARGET_BYTES) -> str | None:
    """Pack the history's small files into bins; returns the new version, None if there is nothing to pack.

    Small bins of earlier versions are packed again with what was appended
    since. One writer compacts at a time (a second one raises); appends may
    go on.
    """
    base = join_path(path, COMPACTED)
    before = committed_versions(spark, base)
    small = {n: size for n, size in live_files(spark, path).items() if size < SMALL * target_bytes}
    bins = [b for b in pack_files(small, target_bytes) if len(b) > 1]
    packed = [n for b in bins for n in b]
    if not packed:
        return None
    name_of = {n: n.rsplit("/", 1)[1] for n in packed}
    # the bins' plan: as many rows as files that are packed
    plan = spark.createDataFrame([(name_of[n], i) for i, b in enumerate(bins) for n in b], f"{FILE} string, {BIN} int")
    rows = spark.read.schema(schema).parquet(*packed).withColumn(FILE, F.col("_metadata.file_name"))
    dealt = rows.join(F.broadcast(plan), FILE).drop(FILE).repartition(len(bins), BIN)
    replaced = spark.createDataFrame([(n,) for n in name_of.values()], f"{FILE} string").coalesce(1)
    both = dealt.withColumn(KIND, F.lit(ROWS)).unionByName(replaced.withColumn(KIND, F.lit(COVERED)), allowMissingColumns=True)
    name = _new_version_name(spark, base)
    both.write.mode("errorifexists").partitionBy(KIND, BIN).parquet(join_path(base, name))
    if [v for v in committed_versions(spark, base) if v != name and v not in before]:
        delete_path(spark, join_path(join_path(base, name), SUCCESS_MARKER))
        raise RuntimeError(f"{name} was withdrawn: another writer compacted {path} meanwhile")
    return name


def vacuum_history(spark: SparkSession, path: str, older_than: float) -> list[str]:
    """Delete files that a version replaces, last changed over ``older_than`` seconds ago; returns
    their names. Choose it above the longest run of a reader, and above what a stream over the
    folder may lag behind: a deleted file never comes through a stream again."""
    versions, limit, out = _versions(spark, path), time.time() - older_than, []
    gone = _replaced(spark, versions)
    for folder in _folders(spark, path, versions):
        for name, changed in sorted(children_changed(spark, folder).items()):
            if name in gone and changed < limit:
                delete_path(spark, join_path(folder, name))
                out.append(name)
    return out
