"""Path helpers over the cluster file system (HDFS, object stores, local).

Listing and deleting go through Hadoop's ``FileSystem`` of the running
session, so the same code works for every scheme the cluster is configured
for.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def _fs_path(spark: SparkSession, path: str):
    try:
        jvm = spark.sparkContext._jvm
    except Exception as e:  # a Spark Connect session has no JVM of its own
        raise RuntimeError("published tables are listed by a classic Spark session, not by Spark Connect") from e
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, hpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _fs_path(spark, path)
    return bool(fs.exists(hpath))


def list_children(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries directly under ``path`` ([] when it is absent)."""
    fs, hpath = _fs_path(spark, path)
    if not fs.exists(hpath):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(hpath))


def children_changed(spark: SparkSession, path: str) -> dict[str, float]:
    """Names directly under ``path`` and when each last changed (epoch seconds)."""
    fs, hpath = _fs_path(spark, path)
    if not fs.exists(hpath):
        return {}
    return {st.getPath().getName(): st.getModificationTime() / 1000 for st in fs.listStatus(hpath)}


def children_sizes(spark: SparkSession, path: str) -> dict[str, int]:
    """Names of the files directly under ``path`` and their sizes in bytes."""
    fs, hpath = _fs_path(spark, path)
    if not fs.exists(hpath):
        return {}
    return {st.getPath().getName(): st.getLen() for st in fs.listStatus(hpath) if st.isFile()}


def delete_path(spark: SparkSession, path: str) -> None:
    fs, hpath = _fs_path(spark, path)
    fs.delete(hpath, True)


def join_path(base: str, name: str) -> str:
    return base.rstrip("/") + "/" + name


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder on storage that driver and executors share (``spark.checkpoint.dir``).

    Where the session names none, a local session gets a temporary folder; on
    a cluster that would lose data, so it raises.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="churnlens-")
        spark.sparkContext.setCheckpointDir(root)
    return join_path(root, f"{name}-{uuid.uuid4().hex}")
