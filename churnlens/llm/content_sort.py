"""Exact dedup by sorting whole texts.

Rows are range-partitioned on the first bytes of their (normalised) text with
splitters that Spark samples, sorted externally on the whole text within each
range, and compared in full with their neighbours: equal texts are adjacent,
so one pass over the sorted run finds every group, its size and the row that
stays. Splitters are prefixes, so what the driver gathers for them is bounded.

A prefix or a whole text that a fixed-size sample shows to be frequent would
fill one range. Rows of a frequent prefix are spread by their digest (equal
texts stay together); rows of a frequent text by their id, so its run is cut
into up to ``SALTS`` sub-runs, which are then joined by their digest, one
summary row each. The sample decides only where rows are sorted, never which
rows are equal.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlens.llm.common import shared_table

#: Characters of a text that splitters see.
PREFIX = 64
#: Rows looked at for frequent prefixes and texts, and how often one must appear among them.
SAMPLE_ROWS = 20_000
SAMPLE_HITS = 8
#: Most frequent prefixes or texts that a sample can show.
MOST = 2 * SAMPLE_ROWS // SAMPLE_HITS
#: Parts of a frequent prefix, and sub-runs of a frequent text.
SALTS = 256

_ID, _TEXT, _DIGEST, _PREFIX, _PART, _SALT, _RANK = "__id", "__text", "__digest", "__prefix", "__part", "__salt", "__rank"
_RUN = (_PREFIX, _PART, _SALT, _TEXT)


def frequent(keyed: DataFrame, columns: tuple[str, ...], seed: int = 7) -> list[list[str]]:
    """For each column the values frequent in a bounded sample of the rows (at most MOST); one pass."""
    share = min(1.0, SAMPLE_ROWS / max(1, keyed.count()))
    cells = F.array(*[F.struct(F.lit(i).alias("i"), F.col(c).alias("v")) for i, c in enumerate(columns)])
    sampled = keyed.select(*columns).sample(share, seed).select(F.explode(cells).alias("x"))
    hits = sampled.groupBy("x.i", "x.v").count().filter(F.col("count") >= SAMPLE_HITS)
    found = hits.orderBy("i", F.desc("count"), "v").limit(MOST * len(columns)).collect()
    return [[r["v"] for r in found if r["i"] == i] for i in range(len(columns))]


def packed(docs: DataFrame, id_col: str, text_col: str, kept: list[str]) -> DataFrame:
    """``docs`` as (__id, __value, __row): the caller's columns can have any names."""
    row = F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)])
    return docs.select(F.col(f"`{id_col}`").alias(_ID), F.col(f"`{text_col}`").alias("__value"), row.alias("__row"))


def sorted_runs(docs: DataFrame, normalise: Callable[[Column], Column] | None, keep: str) -> DataFrame:
    """``packed`` rows with digest, salt and the rank in their run of equal neighbours."""
    text = F.coalesce(F.col("__value"), F.lit(""))
    keyed = (
        docs.withColumn(_TEXT, normalise(text) if normalise else text)
        .drop("__value")
        .withColumn(_PREFIX, F.substring(_TEXT, 1, PREFIX))
        .withColumn(_DIGEST, F.sha2(F.encode(_TEXT, "UTF-8"), 256))
    )
    starts, texts = frequent(keyed, (_PREFIX, _DIGEST))
    # never empty lists: a constant column would drop out of the window's keys, and cost a second shuffle
    starts, texts = starts or [""], texts or [""]
    part = F.when(F.col(_PREFIX).isin(starts), F.pmod(F.hash(_DIGEST), F.lit(SALTS))).otherwise(0)
    salt = F.when(F.col(_DIGEST).isin(texts), F.pmod(F.xxhash64(_ID), F.lit(SALTS)) + 1).otherwise(0)
    ranged = (
        keyed.withColumn(_PART, part.cast("int"))
        .withColumn(_SALT, salt.cast("int"))
        .repartitionByRange(_PREFIX, _PART, _SALT)
    )
    best = F.col(_ID).asc_nulls_last() if keep == "min" else F.col(_ID).desc_nulls_last()
    return ranged.withColumn(_RANK, F.row_number().over(Window.partitionBy(*_RUN).orderBy(best)))


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    normalise: Callable[[Column], Column] | None = None,
    keep: str = "min",
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Null text counts as empty; empty texts form one group. ``keep`` is "min"
    or "max": the row with that id stays. Null ids lose against any id; of rows
    repeated with the same id exactly one is kept. An empty table gives an
    empty result; further columns are ignored.
    """
    runs = sorted_runs(packed(docs, id_col, text_col, []), normalise, keep)
    whole = Window.partitionBy(*_RUN)
    slim = shared_table(
        runs.withColumn("__size", F.count(F.lit(1)).over(whole))
        .withColumn("__best", (F.min if keep == "min" else F.max)(F.col(_ID)).over(whole))
        .select(_ID, _DIGEST, _SALT, _RANK, "__size", "__best"),
        "content-runs",
    )
    # sub-runs of frequent texts: one summary row each, at most SALTS per text
    best = "__best asc nulls last" if keep == "min" else "__best desc nulls last"
    parts = slim.filter((F.col(_SALT) > 0) & (F.col(_RANK) == 1)).select(_DIGEST, _SALT, "__size", "__best")
    joined = parts.groupBy(_DIGEST).agg(
        F.sum("__size").alias("__all"),
        (F.min if keep == "min" else F.max)("__best").alias("__first"),
    )
    winner = (
        parts.withColumn("__w", F.expr(f"row_number() over (partition by {_DIGEST} order by {best}, {_SALT})"))
        .filter("__w = 1")
        .select(_DIGEST, F.col(_SALT).alias("__win"))
    )
    # at most MOST rows, one per frequent text
    stitched = slim.join(F.broadcast(joined.join(winner, _DIGEST)), _DIGEST, "left")
    return stitched.select(
        F.col(_ID).alias(id_col),
        F.coalesce("__first", "__best").alias("keep_id"),
        F.coalesce("__all", "__size").cast("long").alias("group_size"),
        ((F.col(_RANK) == 1) & (F.coalesce("__win", _SALT) == F.col(_SALT))).alias("kept"),
        F.col(_DIGEST).alias("text_sha256"),
    )


def drop_exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    normalise: Callable[[Column], Column] | None = None,
    keep: str = "min",
) -> DataFrame:
    """The rows that stay, with all their columns, whatever their names (same rules as above)."""
    rows = packed(docs, id_col, text_col, docs.columns)
    first = sorted_runs(rows, normalise, keep).filter(F.col(_RANK) == 1)
    best = F.col(_ID).asc_nulls_last() if keep == "min" else F.col(_ID).desc_nulls_last()
    among = Window.partitionBy(_DIGEST).orderBy(best, _SALT)
    stitched = first.filter(F.col(_SALT) > 0).withColumn(_RANK, F.row_number().over(among)).filter(F.col(_RANK) == 1)
    kept = first.filter(F.col(_SALT) == 0).unionByName(stitched)
    return kept.select(*[F.col(f"__row.c{i}").alias(c) for i, c in enumerate(docs.columns)])
