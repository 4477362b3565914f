"""Sinks: versioned full refresh, partition overwrite, history append, JSON."""

from churnlens.sinks.incremental import (
    KeyedTable,
    LoadResult,
    load_incremental,
    part_paths,
    read_keyed,
    refresh_keyed,
    vacuum_keyed,
)
from churnlens.sinks.publish import (
    append,
    committed_versions,
    create_table_as,
    current_version_path,
    overwrite_partitions,
    publish,
    read_partitioned,
    read_published,
    vacuum,
    write_json,
)

__all__ = [
    "KeyedTable",
    "LoadResult",
    "append",
    "committed_versions",
    "create_table_as",
    "current_version_path",
    "load_incremental",
    "overwrite_partitions",
    "part_paths",
    "publish",
    "read_keyed",
    "read_partitioned",
    "read_published",
    "refresh_keyed",
    "vacuum",
    "vacuum_keyed",
    "write_json",
]
