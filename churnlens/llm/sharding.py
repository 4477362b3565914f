"""Sharding by vector bin packing.

Groups of rows (equal texts) are vectors (bytes, tokens, rows). Largest first,
each goes to the shard where the dot product of its vector with the residual
capacity is highest, among the shards that still have room for it.

Packing every group one after the other would run on one machine, so it is
done on a bounded number of items: a group that holds more than 1/BUNDLES of
any dimension is an item of its own (there are at most 3 * BUNDLES of those),
and all other groups are hashed into BUNDLES bundles. A group larger than a
whole shard is cut into pieces, as no packing could balance it otherwise.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlens.llm.common import own_name, shared_table, utf8_crc32, word_count

BUNDLES = 4096
#: Rows numbered together when slots are dealt.
BLOCK_ROWS = 2000


def pack(vectors: np.ndarray, n_shards: int) -> np.ndarray:
    """Shard of each item; ``vectors`` is (items, dimensions).

    The first dimension breaks off last: when no shard has room for an item,
    the one least loaded in that dimension takes it.
    """
    capacity = np.maximum(vectors.sum(axis=0) / n_shards, 1e-300)
    need = vectors / capacity
    residual = np.ones((n_shards, need.shape[1]))
    shard = np.zeros(len(need), dtype=np.int64)
    for i in np.argsort(-need.max(axis=1), kind="stable"):
        room = (residual >= need[i]).all(axis=1)
        score = residual @ need[i] if room.any() else residual[:, 0]
        best = int(np.argmax(np.where(room, score, -np.inf) if room.any() else score))
        shard[i] = best
        residual[best] -= need[i]
    return shard


def shard_documents(
    docs: DataFrame, n_shards: int = 8, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: id, size, tokens, text_crc32, shard, slot.

    ``size`` is the UTF-8 bytes of the text plus 1; a null text has none, 0
    tokens and the crc of nothing, and shares a group with the empty text.
    Slots number each shard's rows from 0 without gaps. Repeated rows are
    placed together and get slots of their own; an empty table gives none.
    Further columns are ignored, but the id must not be named like a column of
    the result.
    """
    own_name(id_col, ("size", "tokens", "text_crc32", "shard", "slot", "bytes", "rows"))
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    slim = shared_table(
        docs.select(
            id_col,
            (F.octet_length(text) + 1).cast("long").alias("size"),
            word_count(text).alias("tokens"),
            utf8_crc32(text).alias("text_crc32"),
            F.unhex(F.sha2(F.encode(text, "UTF-8"), 256)).alias("__group"),
        ),
        "shard-rows",
    )
    vector = [F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")]
    groups = slim.groupBy("__group").agg(*vector)
    total = slim.agg(*vector).first()
    dims = ("bytes", "tokens", "rows")
    share = F.greatest(*[F.col(d) * n_shards / F.lit(max(1, total[d] or 0)) for d in dims])
    heavy = groups.filter(share > n_shards / BUNDLES).select(
        "__group", F.when(share > 1, F.ceil(share)).otherwise(1).cast("int").alias("__pieces")
    )
    # at most 3 * BUNDLES rows: each holds over 1/BUNDLES of one of three totals
    dealt = slim.join(F.broadcast(heavy), "__group", "left")
    piece = F.pmod(F.xxhash64(id_col), F.col("__pieces"))
    item = F.when(
        F.col("__pieces").isNotNull(), F.concat_ws(":", F.lit("g"), F.hex("__group"), piece.cast("string"))
    ).otherwise(F.concat_ws(":", F.lit("b"), F.pmod(F.xxhash64("__group"), F.lit(BUNDLES)).cast("string")))
    dealt = dealt.withColumn("__item", item)
    items = sorted(tuple(r) for r in dealt.groupBy("__item").agg(*vector).collect())
    placed = pack(np.array([r[1:] for r in items], dtype=float).reshape(-1, 3), n_shards)
    places = spark.createDataFrame(
        [(r[0], int(s)) for r, s in zip(items, placed, strict=True)], "__item string, shard int"
    )
    return number_slots(
        dealt.join(F.broadcast(places), "__item").select(id_col, "size", "tokens", "text_crc32", "shard"),
        id_col,
        max(1, math.ceil((total["rows"] or 0) / (n_shards * BLOCK_ROWS))),
    )


def number_slots(rows: DataFrame, id_col: str, n_blocks: int) -> DataFrame:
    """Adds ``slot``: rows of each shard numbered from 0, block by block."""
    block = F.pmod(F.xxhash64(id_col, "text_crc32", "size"), F.lit(n_blocks))
    blocked = rows.withColumn("__block", block)
    counts = blocked.groupBy("shard", "__block").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("shard").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("shard", "__block", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    inside = Window.partitionBy("shard", "__block").orderBy(id_col, "text_crc32", "size")
    numbered = blocked.withColumn("__k", F.row_number().over(inside)).join(base, ["shard", "__block"])
    return numbered.withColumn("slot", F.col("__base") + F.col("__k") - 1).drop("__block", "__k", "__base")
