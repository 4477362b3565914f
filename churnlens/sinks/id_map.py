"""Anonymous ids that stay the same across loads.

A mapping table ``id -> uuid`` is extended by the ids it does not have yet.
New uuids are drawn once, into files that are committed before anybody uses
them, so a retried task, a repeated load or a failed one never gives an id a
second uuid that is seen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlens.functions.expressions import sql_ident
from churnlens.sinks.incremental import KeyedTable, LoadResult, load_incremental, read_keyed
from churnlens.sinks.publish import committed_versions

ID, UUID = "id", "uuid"


def id_map_table(base: str, id_type: T.DataType, parts: int = 64) -> KeyedTable:
    """The mapping table at ``base``; new ids are spread over ``parts`` parts by their hash."""
    schema = T.StructType([T.StructField(ID, id_type), T.StructField(UUID, T.StringType())])
    return KeyedTable(base, schema, (ID,), f"pmod(xxhash64({ID}), {parts})")


def extend_id_map(df: DataFrame, id_col: str, table: KeyedTable) -> LoadResult:
    """Give every non-NULL id of ``df`` that has no uuid yet a random one (version 4)."""
    spark = df.sparkSession
    ids = df.select(F.col(sql_ident(id_col)).alias(ID)).filter(F.col(ID).isNotNull()).distinct()
    if committed_versions(spark, table.base):
        known = read_keyed(spark, table).select(ID)
        ids = ids.join(known, ID, "left_anti")
    # drawn once: the load writes its rows before it looks at them
    return load_incremental(ids.withColumn(UUID, F.uuid()), table)


def anonymize_mapped(df: DataFrame, id_col: str, out_col: str, table: KeyedTable) -> DataFrame:
    """``df`` with the mapped uuid in ``out_col``; ``id_col`` is dropped.

    Extends the mapping first, so every non-NULL id has its uuid, the same one
    as in earlier loads. A NULL id stays NULL. The join is on the id; a
    column of the name ``out_col`` is replaced.
    """
    extend_id_map(df, id_col, table)
    mapping = read_keyed(df.sparkSession, table).select(F.col(ID).alias("__id"), F.col(UUID).alias("__uuid"))
    kept = [c for c in df.columns if c not in (id_col, out_col)]
    joined = df.alias("d").join(mapping, F.col(f"d.{sql_ident(id_col)}") == F.col("__id"), "left")
    return joined.select(*[F.col(f"d.{sql_ident(c)}") for c in kept], F.col("__uuid").alias(out_col))
