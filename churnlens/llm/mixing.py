"""Mixing sources to target weights by a low-discrepancy schedule.

Each source's documents are shuffled (by a hash of the id) into one stream of
words and cut into equal-word blocks. Slot ``i`` of the mix looks at the
golden-ratio point ``i * phi mod 1``; mapped through the cumulative weights it
names a source, and the slot's rank among that source's slots names the block
(ranks beyond the last block start the next epoch). Ranks need no window: how
many points below ``i`` fall in an interval is a floor sum, so each chunk of
slots is generated on its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlens.llm.common import arrow_schema, own_name, shared_table, utf8_crc32, word_count

WEIGHTS = (5, 2, 1)
#: Largest multiple of its size that a source may be used.
CAP = 3
#: Words of a block at most, and slots of a source at least (smaller targets get smaller blocks).
BLOCK_WORDS = 4096
MIN_SLOTS = 1024
CHUNK = 1 << 16
ONE = 1 << 64
#: 2**64 / golden ratio, odd.
STEP = 0x9E3779B97F4A7C15
#: Columns of a mix besides the id.
MIX_COLUMNS = ("source_no", "size", "text_crc32", "start", "source_size", "target", "block_words", "block", "copies", "taken")
#: Documents ordered together when a stream's positions are summed.
BUCKET_ROWS = 500


@dataclass(frozen=True)
class Source:
    """One source: its words, its target, and its cut into ``blocks`` of ``block_words``."""

    name: str | None
    rows: int
    words: int
    target: Fraction
    block_words: int
    blocks: int
    slots: int


def targets(words: list[int], weights=WEIGHTS, cap: int = CAP) -> list[Fraction]:
    """Shares of all words by weight, none above ``cap`` times its source.

    What is above goes back to the others by weight until none is above.
    """
    weight = [weights[i % len(weights)] for i in range(len(words))]
    fixed: dict[int, Fraction] = {}
    while True:
        rest = sum(words) - sum(fixed.values())
        open_weight = sum(w for i, w in enumerate(weight) if i not in fixed)
        share = [Fraction(rest * w, open_weight) if open_weight else Fraction(0) for w in weight]
        over = [i for i in range(len(words)) if i not in fixed and share[i] > cap * words[i]]
        if not over:
            return [fixed.get(i, share[i]) for i in range(len(words))]
        fixed |= {i: Fraction(cap * words[i]) for i in over}


def plan_sources(stats: list[tuple[str | None, int, int]]) -> list[Source]:
    """Sources in code point order, null last, with targets, blocks and slots."""
    stats = sorted(stats, key=lambda s: (s[0] is None, s[0] or ""))
    out, rests = [], []
    for (name, rows, words), target in zip(stats, targets([s[2] for s in stats]), strict=True):
        size = max(1, min(BLOCK_WORDS, int(target) // MIN_SLOTS))
        blocks = -(-words // size)
        epochs, rest = divmod(target, words) if words else (0, 0)
        own, rest = divmod(Fraction(rest), size)
        out.append(Source(name, rows, words, target, size, blocks, int(epochs) * blocks + int(own) if words else 0))
        rests.append(rest)
    # the words that whole slots leave over go to the largest remainders, so that the sum holds too
    left = sum(rests)
    for i in sorted(range(len(out)), key=lambda i: (-rests[i] / out[i].block_words, i)):
        s = out[i]
        if rests[i] and 2 * left >= s.block_words and s.slots < CAP * s.blocks:
            out[i] = replace(s, slots=s.slots + 1)
            left -= s.block_words
    return out


def floor_sum(n: int, m: int, a: int, b: int) -> int:
    """Sum of floor((a i + b) / m) for 0 <= i < n, in logarithmic time."""
    total = 0
    while n:
        total += (n - 1) * n // 2 * (a // m) + n * (b // m)
        a, b = a % m, b % m
        top = a * n + b
        if top < m:
            break
        n, b, m, a = top // m, top % m, a, m
    return total


def points_below(n: int, edge: int) -> int:
    """How many of the first ``n`` points i * STEP mod 2**64 are below ``edge``."""
    return floor_sum(n, ONE, STEP, 0) - floor_sum(n, ONE, STEP, ONE - edge) + n


class Schedule:
    """Which source and block each slot takes; picklable, a few numbers per source."""

    def __init__(self, sources: list[Source]):
        slots = [s.slots for s in sources]
        self.total = sum(slots)
        sums = np.cumsum([0, *slots]).tolist()
        self.edges = [x * ONE // max(1, self.total) for x in sums]
        self.slots, self.blocks = np.array(slots, dtype=np.int64), np.array([max(1, s.blocks) for s in sources])
        # a few slots more than wanted, until each source has its number; the surplus is skipped
        self.length, more = self.total, max(64, self.total // 64)
        while self.total and any(x < y for x, y in zip(self.counts(self.length), slots, strict=True)):
            self.length += more

    def counts(self, n: int) -> list[int]:
        below = [points_below(n, e) for e in self.edges]
        return [b - a for a, b in zip(below, below[1:], strict=False)]

    def chunk(self, k: int) -> pd.DataFrame:
        """Slots of chunk ``k``: slot, source index, block, epoch."""
        first, last = k * CHUNK, min((k + 1) * CHUNK, self.length)
        slot = np.arange(first, last, dtype=np.int64)
        at = slot.astype(np.uint64) * np.uint64(STEP)
        inner = np.array([min(e, ONE - 1) for e in self.edges[1:-1]], dtype=np.uint64)
        source = np.searchsorted(inner, at, side="right")
        order = np.argsort(source, kind="stable")
        starts = np.searchsorted(source[order], np.arange(len(self.slots)))
        rank = np.empty(len(slot), dtype=np.int64)
        rank[order] = np.arange(len(slot)) - starts[source[order]]
        rank += np.array(self.counts(first), dtype=np.int64)[source]
        used = rank < self.slots[source]
        slot, source, rank = slot[used], source[used], rank[used]
        return pd.DataFrame(
            {"slot": slot, "source_no": source.astype(np.int32), "block": rank % self.blocks[source], "epoch": rank // self.blocks[source]}
        )


def schedule_table(spark, plan: Schedule) -> DataFrame:
    """(slot, source_no, block, epoch), generated chunk by chunk on the executors."""

    def chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for k in batch["id"]:
                yield plan.chunk(int(k))

    n = -(-plan.length // CHUNK)
    return spark.range(n, numPartitions=max(1, n)).mapInPandas(
        chunks, "slot long, source_no int, block long, epoch long"
    )


def source_table(spark, sources: list[Source]) -> DataFrame:
    """A row of numbers per source, sent as Arrow: rows of plain Python would start further workers on the executors."""
    kind = "source_no int, __name string, source_size long, target double, block_words long, __buckets long"
    columns = zip(
        *[(i, s.name, s.words, float(s.target), s.block_words, 1 + s.rows // BUCKET_ROWS) for i, s in enumerate(sources)],
        strict=True,
    )
    schema = arrow_schema(kind)
    return spark.createDataFrame(pa.table(list(columns) or [[]] * len(schema), schema=schema), kind)


@dataclass(frozen=True)
class Mix:
    """``rows``: id, source_no, size, text_crc32, start (place in the source's
    stream), source_size, target, block_words; ``schedule``: the slots."""

    rows: DataFrame
    schedule: DataFrame
    sources: list[Source]

    def pieces(self) -> DataFrame:
        """Words of each document in each block: source_no, block, start, words."""
        first = F.expr("start div block_words")
        last = F.expr("(start + size - 1) div block_words")
        cut = self.rows.filter("size > 0").select("*", F.explode(F.sequence(first, last)).alias("block"))
        words = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * F.col("block_words")) - F.greatest(
            "start", F.col("block") * F.col("block_words")
        )
        return cut.select("source_no", "block", "start", words.alias("words"))

    def mixed(self) -> DataFrame:
        """The mix: slot, epoch, and the documents' words that it takes."""
        return self.schedule.join(self.pieces(), ["source_no", "block"])

    def taken(self) -> DataFrame:
        """``rows`` with ``taken``, the words that the mix takes, repeats counted."""
        sums = self.mixed().groupBy("source_no", "start").agg(F.sum("words").alias("taken"))
        full = self.rows.filter("size > 0").join(sums, ["source_no", "start"], "left")
        none = self.rows.filter("size = 0").withColumn("taken", F.lit(0).cast("long"))
        return full.unionByName(none).withColumn("taken", F.coalesce("taken", F.lit(0)))

    def copies(self) -> DataFrame:
        """``rows`` with ``copies``: how often the mix takes the block of its first word."""
        times = self.schedule.groupBy("source_no", "block").agg(F.count(F.lit(1)).alias("copies"))
        placed = self.rows.withColumn("block", F.expr("least(start, greatest(source_size - 1, 0)) div block_words"))
        return placed.join(times, ["source_no", "block"], "left").withColumn("copies", F.coalesce("copies", F.lit(0)))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> Mix:
    """Plan the mix of all ``docs``.

    A null text has size 0 and is never taken; a null source is a source of
    its own; ties in the shuffle are broken by id, size and crc, so reruns
    agree, and repeated rows are taken separately. The driver holds a few
    numbers per source. An empty table gives an empty mix; further columns are
    ignored, but the id must not be named like a column of the result. A
    source takes whole blocks (of one word at least, 1/1024 of its target at
    most), so it comes within a block of its target, and all together within
    the largest block of theirs.
    """
    own_name(id_col, MIX_COLUMNS)
    text = F.coalesce(F.col(text_col), F.lit(""))
    slim = shared_table(
        docs.select(
            id_col,
            F.col(source_col).alias("__source"),
            word_count(text).alias("size"),
            utf8_crc32(text).alias("text_crc32"),
            F.xxhash64(F.lit(id_col), id_col).alias("__h"),
        ),
        "mix-rows",
    )
    stats = slim.groupBy("__source").agg(F.count(F.lit(1)), F.sum("size")).collect()
    sources = plan_sources([tuple(r) for r in stats])
    spark = docs.sparkSession
    named = source_table(spark, sources)
    keyed = (
        slim.join(named, F.col("__source").eqNullSafe(F.col("__name")))
        .withColumn("__bucket", F.pmod("__h", "__buckets"))
        .drop("__name", "__buckets")
    )
    sums = keyed.groupBy("source_no", "__bucket").agg(F.sum("size").alias("__n"))
    before = Window.partitionBy("source_no").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("source_no", "__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    inside = (
        Window.partitionBy("source_no", "__bucket")
        .orderBy("__h", id_col, "size", "text_crc32")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    rows = (
        keyed.withColumn("__in", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(base, ["source_no", "__bucket"])
        .withColumn("start", F.col("__base") + F.col("__in"))
        .drop("__bucket", "__base", "__in", "__h")
    )
    return Mix(shared_table(rows, "mix-streams", sum(s.rows for s in sources)), schedule_table(spark, Schedule(sources)), sources)


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The documents as often as the mix takes the block of their first word."""
    mix = mix_sources(docs, id_col, text_col, source_col)
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = [F.col(id_col).alias("__i"), F.col(source_col).alias("__s"), utf8_crc32(text).alias("__c")]
    copies = (
        mix.copies()
        .groupBy(F.col(id_col).alias("__i"), F.col("__source").alias("__s"), F.col("text_crc32").alias("__c"))
        .agg(F.max("copies").alias("__copies"))
        .filter("__copies > 0")
    )
    marked = docs.select("*", *key).alias("d")
    same = [F.col(f"d.{c}").eqNullSafe(F.col(f"m.{c}")) for c in ("__i", "__s", "__c")]
    joined = marked.join(copies.alias("m"), same[0] & same[1] & same[2])
    return joined.select(
        *[F.col(f"d.`{c}`") for c in docs.columns],
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("m.__copies"))).alias("__n"),
    ).drop("__n")
