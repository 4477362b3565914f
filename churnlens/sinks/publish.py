"""Table sinks: versioned full refresh, append, JSON.

A full refresh never deletes the data readers are using. Each write goes to a
new version directory under the table's base path; Spark's commit protocol
moves files into it and writes ``_SUCCESS`` only when the whole job
succeeded. Readers take the version with the highest number that has
``_SUCCESS``, so a failed or half-written refresh leaves the previous table in
place, and a retried task never leaves duplicate files behind. Numbers come
from the listing, not from a clock, and publishing never deletes anything:
:func:`vacuum` does, when asked to.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlens.operators.conform import conform
from churnlens.sinks.storage import children_changed, delete_path, join_path, list_children, path_exists

VERSION_PREFIX = "v="
SUCCESS_MARKER = "_SUCCESS"


def _version_number(name: str) -> int:
    digits = name[len(VERSION_PREFIX) :].split("-")[0]
    return int(digits) if digits.isdecimal() else -1


def _new_version_name(spark: SparkSession, base: str) -> str:
    """One above the highest number in use, whether committed or not; the
    suffix keeps two writers that saw the same listing apart."""
    taken = [_version_number(n) for n in list_children(spark, base) if n.startswith(VERSION_PREFIX)]
    return f"{VERSION_PREFIX}{max(taken, default=0) + 1:015d}-{uuid.uuid4().hex[:8]}"


def committed_versions(spark: SparkSession, base: str) -> list[str]:
    """Committed version directories of a table, oldest first."""
    out = []
    for name in list_children(spark, base):
        if name.startswith(VERSION_PREFIX) and path_exists(
            spark, join_path(join_path(base, name), SUCCESS_MARKER)
        ):
            out.append(name)
    return out


def current_version_path(spark: SparkSession, base: str) -> str:
    """Path of the highest committed version; ``FileNotFoundError`` if none."""
    versions = committed_versions(spark, base)
    if not versions:
        raise FileNotFoundError(f"no published table at {base}")
    return join_path(base, versions[-1])


def read_published(spark: SparkSession, base: str, schema: T.StructType, version: str | None = None) -> DataFrame:
    """Read a published table with its declared schema: as it is now, or as of a committed version."""
    if version is None:
        path = current_version_path(spark, base)
    elif version in committed_versions(spark, base):
        path = join_path(base, version)
    else:
        raise FileNotFoundError(f"no committed version {version} at {base}")
    return spark.read.schema(schema).parquet(path).select(*schema.names)  # partition columns would come last


def publish(
    df: DataFrame,
    base: str,
    schema: T.StructType | None = None,
    partition_by: list[str] | None = None,
) -> tuple[str, int]:
    """Full refresh of the table at ``base``: write a new version.

    Returns ``(version_path, rows_written)``. The row count is observed while
    writing (no second pass over the data, and no second evaluation of
    random columns). Raises ``RuntimeError`` when another writer's version is
    the current one afterwards; the version written here then stays unread.
    """
    spark = df.sparkSession
    if schema is not None:
        df = conform(df, schema)
    target = join_path(base, _new_version_name(spark, base))
    obs = Observation("publish")
    writer = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(target)
    rows = int(obs.get["rows"])
    current = current_version_path(spark, base)
    if current != target:
        raise RuntimeError(f"{target} was written, but another writer made {current} the current version")
    return target, rows


def vacuum(spark: SparkSession, base: str, older_than: float) -> list[str]:
    """Delete versions, committed or left by a failed write, last changed over
    ``older_than`` seconds ago; returns their names. The current version and
    any with a higher number (a write that may be running) are never touched.
    Choose ``older_than`` above the longest run of a reader."""
    current = committed_versions(spark, base)[-1:]
    changed = children_changed(spark, base)
    limit = time.time() - older_than
    old = [n for n in sorted(changed) if current and n.startswith(VERSION_PREFIX) and n < current[0] and changed[n] < limit]
    for name in old:
        delete_path(spark, join_path(base, name))
    return old


def overwrite_partitions(df: DataFrame, path: str, schema: T.StructType, partition_by: list[str]) -> int:
    """Incremental load: replace only the partitions that ``df`` has rows for.

    Returns the rows written; read the table back with :func:`read_partitioned`.
    """
    obs = Observation("partitions")
    observed = conform(df, schema).observe(obs, F.count(F.lit(1)).alias("rows"))
    writer = observed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).parquet(path)
    return int(obs.get["rows"])


def read_partitioned(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A partitioned table with its declared columns, in their order."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def create_table_as(df: DataFrame, name: str, mode: str = "errorifexists") -> None:
    """Create a catalog table from a frame (``CREATE TABLE ... AS SELECT``)."""
    df.write.mode(mode).saveAsTable(name)


def append(df: DataFrame, path: str, schema: T.StructType | None = None) -> int:
    """Append rows to a history table; returns the number of rows appended."""
    if schema is not None:
        df = conform(df, schema)
    obs = Observation("append")
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("append").parquet(path)
    return int(obs.get["rows"])


def write_json(df: DataFrame, path: str) -> None:
    """Report rows as JSON lines, one object per row, NULL fields included."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)
