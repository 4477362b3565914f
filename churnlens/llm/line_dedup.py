"""Line dedup: documents probe sharded minimal perfect hashes.

Each document's long lines become 128-bit hashes of their normalised text.
The distinct hashes, with the number of documents that hold the line and the
largest id among them, are dealt into shards; each shard is a minimal perfect
hash (levels of bits; a hash takes the first level where no other hash has its
bit, and the rank of that bit is its slot) over three arrays: fingerprints,
counts and last ids. Documents then probe the arrays: lines are never joined
with lines.

At scale: hashes are counted with a partial aggregate, so a line that stands
in every document is one row per task. A shard's arrays and the probes for it
meet by one shuffle on the shard, sorted so that the arrays come first: a task
holds the arrays of one shard (about SHARD_LINES slots) and streams the
probes. A line so frequent that its probes would fill a task (at most HOT of
these can exist) is answered from a broadcast instead. What comes back are
positions of lines, one row per document that loses any.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlens.llm.common import arrow_schema, bound_batches, shared_table, shuffle_width

#: Line hashes in a shard, and shards per shuffle partition at least.
SHARD_LINES = 1 << 15
SHARDS_A_TASK = 4
#: Bits per hash left at a level of the perfect hash.
GAMMA = 2.0
#: Lines that hold over 1/HOT of all rows of lines are answered from a broadcast (fewer than HOT can).
HOT = 4096
#: Documents are cut into lines in runs of about so many bytes.
RUN_BYTES = 1 << 22

SPACE = b" \t\n\x0b\x0c\r"
#: A null id counts as the least one.
NO_ID = -(1 << 63)

LINE_SCHEMA = "id long, text_hash long, h1 long, h2 long, at array<int>"
INDEX_SCHEMA = (
    "shard int, keys long, sizes array<int>, bits binary, fingerprints binary, "
    "counts binary, count_bytes int, lasts binary, hot array<struct<h1:long,h2:long,hot_docs:long,hot_last:long>>"
)
GONE_SCHEMA = "id long, text_hash long, at array<int>"
KEPT_SCHEMA = "id long, kept_text string, n_lines long, n_dropped long"


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """Normalised line, or None where it has fewer than ``min_chars`` code points."""
    key = line.strip(SPACE).lower()  # of bytes: A-Z alone
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode()) < min_chars):
        return None
    return key


def _mixed(h1: np.ndarray, h2: np.ndarray, seed: int) -> np.ndarray:
    """64 mixed bits of the two halves, another function for each seed."""
    turn = np.uint64(1 + 2 * seed % 63)
    x = h1 ^ ((h2 << turn) | (h2 >> (np.uint64(64) - turn)))
    x = x + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _bit(h1: np.ndarray, h2: np.ndarray, level: int, size: int) -> np.ndarray:
    return (((_mixed(h1, h2, level) >> np.uint64(32)) * np.uint64(size)) >> np.uint64(32)).astype(np.int64)


def fingerprint(h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    return _mixed(h2, h1, 1000).astype(np.uint32)


class PerfectHash:
    """Slots 0 .. n-1 of n distinct 128-bit hashes, in some 3 to 4 bits each."""

    def __init__(self, sizes: list[int], words: np.ndarray):
        self.sizes, self.words = sizes, words
        held = np.bitwise_count(words).astype(np.int64)
        self.rank = np.cumsum(held) - held

    @classmethod
    def of(cls, h1: np.ndarray, h2: np.ndarray) -> PerfectHash:
        sizes, levels, a, b = [], [], h1, h2
        while len(a):
            if len(sizes) > 200:
                raise ValueError("a perfect hash needs distinct hashes")
            size = max(64, -(-int(GAMMA * len(a)) // 64) * 64)
            bit = _bit(a, b, len(sizes), size)
            alone = np.bincount(bit, minlength=size) == 1
            levels.append(np.packbits(alone, bitorder="little"))
            sizes.append(size)
            left = ~alone[bit]
            a, b = a[left], b[left]
        packed = np.concatenate(levels) if levels else np.zeros(0, dtype=np.uint8)
        return cls(sizes, packed.view(np.uint64))

    def slots(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Slot of each hash; a hash that was not indexed gets any slot, or -1."""
        out = np.full(len(h1), -1, dtype=np.int64)
        open_, offset = np.arange(len(h1)), 0
        for level, size in enumerate(self.sizes):
            if not len(open_):
                break
            bit = _bit(h1[open_], h2[open_], level, size) + offset
            word, shift = self.words[bit >> 6], (bit & 63).astype(np.uint64)
            hit = ((word >> shift) & np.uint64(1)) == 1
            below = word & ((np.uint64(1) << shift) - np.uint64(1))
            out[open_[hit]] = (self.rank[bit >> 6] + np.bitwise_count(below))[hit]
            open_, offset = open_[~hit], offset + size
        return out


class LineArrays:
    """One shard: the perfect hash with its fingerprint, count and last-id arrays."""

    def __init__(self, row: dict):
        self.hash = PerfectHash(list(row["sizes"]), np.frombuffer(row["bits"], dtype=np.uint64))
        self.fingerprints = np.frombuffer(row["fingerprints"], dtype=np.uint32)
        self.counts = np.frombuffer(row["counts"], dtype=f"u{row['count_bytes']}")
        self.lasts = np.frombuffer(row["lasts"], dtype=np.int64)

    def probe(self, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents that hold each line (0: not indexed) and the last of them."""
        if not len(self.lasts):
            return np.zeros(len(h1), dtype=np.int64), np.full(len(h1), NO_ID)
        h1, h2 = h1.view(np.uint64), h2.view(np.uint64)
        slot = self.hash.slots(h1, h2)
        known = (slot >= 0) & (self.fingerprints[slot] == fingerprint(h1, h2))
        return np.where(known, self.counts[slot].astype(np.int64), 0), np.where(known, self.lasts[slot], NO_ID)


def shard_row(shard: int, h1: np.ndarray, h2: np.ndarray, n: np.ndarray, last: np.ndarray, hot_from: int) -> dict:
    a, b = h1.view(np.uint64), h2.view(np.uint64)
    found = PerfectHash.of(a, b)
    slot = found.slots(a, b)
    width = np.min_scalar_type(int(n.max(initial=0))).itemsize
    prints, counts, lasts = np.empty(len(a), np.uint32), np.empty(len(a), f"u{width}"), np.empty(len(a), np.int64)
    prints[slot], counts[slot], lasts[slot] = fingerprint(a, b), n, last
    return {
        "shard": shard,
        "keys": len(a),
        "sizes": found.sizes,
        "bits": found.words.tobytes(),
        "fingerprints": prints.tobytes(),
        "counts": counts.tobytes(),
        "count_bytes": width,
        "lasts": lasts.tobytes(),
        "hot": [
            {"h1": int(h1[i]), "h2": int(h2[i]), "hot_docs": int(n[i]), "hot_last": int(last[i])}
            for i in np.flatnonzero(n >= hot_from)
        ],
    }


def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """One row per document (id, text, text_hash) and distinct line key: its hash and the lines that have it."""
    schema = arrow_schema(LINE_SCHEMA)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(rows: list[tuple]) -> pa.RecordBatch:
            ids, texts, hashes, at = zip(*rows, strict=True)
            h = np.frombuffer(b"".join(hashes), dtype=np.int64).reshape(-1, 2)
            arrays = [pa.array(ids), pa.array(texts), pa.array(h[:, 0]), pa.array(h[:, 1]), pa.array(at, pa.list_(pa.int32()))]
            return pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, schema, strict=True)], schema=schema)

        for batch in batches:
            rows, size = [], 0
            for doc, text, text_hash in zip(*batch.columns, strict=True):
                whole = (text.as_py() or "").encode()
                at: dict[bytes, list[int]] = {}
                for i, line in enumerate(whole.split(b"\n")):
                    key = line_key(line, min_chars)
                    if key is not None:
                        at.setdefault(hashlib.blake2b(key, digest_size=16).digest(), []).append(i)
                rows += [(doc.as_py(), text_hash.as_py(), h, lines) for h, lines in at.items()]
                size += len(whole)
                if size > RUN_BYTES and rows:
                    yield packed(rows)
                    rows, size = [], 0
            if rows:
                yield packed(rows)

    return docs.select("id", "text", "text_hash").mapInArrow(cut, LINE_SCHEMA)


@dataclass
class LineIndex:
    """The shards of all distinct line hashes, one row each."""

    shards: DataFrame
    n_shards: int

    def shard_of(self) -> Column:
        return F.pmod("h1", F.lit(self.n_shards)).cast("int")

    def frequent(self) -> DataFrame:
        """(h1, h2, hot_docs, hot_last) of fewer than HOT lines."""
        return self.shards.select(F.explode("hot").alias("line")).select("line.*")


def build_index(lines: DataFrame) -> LineIndex:
    """Index all distinct hashes of ``lines``, a stored table."""
    n_lines = lines.count()
    n_shards = max(-(-n_lines // SHARD_LINES), SHARDS_A_TASK * shuffle_width(lines.sparkSession))
    hot_from = n_lines // HOT + 1
    schema = arrow_schema(INDEX_SCHEMA)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []

        def row() -> pa.RecordBatch:
            shard, *columns = (np.concatenate(c) for c in zip(*held, strict=True))
            held.clear()
            return pa.RecordBatch.from_pylist([shard_row(int(shard[0]), *columns, hot_from)], schema=schema)

        for batch in batches:
            columns = [c.to_numpy() for c in batch.columns]
            cuts = np.flatnonzero(np.diff(columns[0])) + 1
            for part in zip(*(np.split(c, cuts) for c in columns), strict=True):
                if not len(part[0]):
                    continue
                if held and held[-1][0][0] != part[0][0]:
                    yield row()
                held.append(list(part))
        if held:
            yield row()

    index = LineIndex(lines, n_shards)
    counted = lines.groupBy("h1", "h2").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.coalesce("id", F.lit(NO_ID))).alias("last")
    )
    dealt = counted.select(index.shard_of().alias("shard"), "h1", "h2", "n", "last")
    built = dealt.repartition("shard").sortWithinPartitions("shard").mapInArrow(build, INDEX_SCHEMA)
    # a task that reads and merges its sorted partitions one after the other still sees each shard whole
    return LineIndex(shared_table(built, "line-index", n_lines), n_shards)


def _probed(asks: DataFrame, index: LineIndex, min_docs: int) -> DataFrame:
    """The rows of ``asks`` whose line goes: each shard's arrays first, then the probes for it."""
    schema = arrow_schema(GONE_SCHEMA)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = None
        for batch in batches:
            starts = np.flatnonzero(batch.column("kind").to_numpy() == 0)
            edges = [0, *starts.tolist(), batch.num_rows]
            for i, (start, end) in enumerate(zip(edges, edges[1:], strict=False)):
                if i:  # every run but the first one starts with its shard's arrays
                    arrays = LineArrays(batch.slice(start, 1).to_pylist()[0])
                    start += 1
                if start >= end:
                    continue
                some = batch.slice(start, end - start)
                n, last = arrays.probe(some.column("h1").to_numpy(), some.column("h2").to_numpy())
                ids = some.column("id").fill_null(NO_ID).to_numpy()
                goes = some.filter(pa.array((n >= min_docs) & (ids != last)))
                if goes.num_rows:
                    yield pa.RecordBatch.from_arrays([goes.column(f.name).cast(f.type) for f in schema], schema=schema)

    arrays = index.shards.drop("keys", "hot").withColumn("kind", F.lit(0).cast("byte"))
    dealt = asks.select("*", index.shard_of().alias("shard"), F.lit(1).cast("byte").alias("kind"))
    both = arrays.unionByName(dealt, allowMissingColumns=True)
    return both.repartition("shard").sortWithinPartitions("shard", "kind").mapInArrow(probe, GONE_SCHEMA)


def lost_lines(lines: DataFrame, index: LineIndex, min_docs: int) -> DataFrame:
    """(id, text_hash, gone): positions of the lines that documents lose, where there are any."""
    # fewer than HOT rows: each has over 1/HOT of all rows of lines
    asks = lines.join(F.broadcast(index.frequent()), ["h1", "h2"], "left")
    answered = asks.filter(
        (F.col("hot_docs") >= min_docs) & (F.coalesce("id", F.lit(NO_ID)) != F.col("hot_last"))
    ).select("id", "text_hash", "at")
    probed = _probed(asks.filter(F.col("hot_docs").isNull()).drop("hot_docs", "hot_last"), index, min_docs)
    gone = F.array_distinct(F.flatten(F.collect_set("at")))
    return answered.unionByName(probed).groupBy("id", "text_hash").agg(gone.alias("gone"))


def drop_repeated_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 5, min_chars: int = 40
) -> DataFrame:
    """One row per input row: id, kept_text, n_lines, n_dropped.

    A line goes where its key (stripped of white space, A-Z lowered) has at
    least ``min_chars`` code points and stands in ``min_docs`` rows or more,
    unless the row's id is the largest of those; ``n_lines`` counts lines
    before that. A null or empty text is one empty line, and ``kept_text`` is
    empty where no line stays. Ids are whole numbers (others raise); a null
    id counts as the least of all. Each row is a document: of rows with the
    same, largest id, all keep the line. An empty table gives an empty
    result; further columns are ignored, whatever their names.
    """
    id_type = docs.schema[id_col].dataType
    if not isinstance(id_type, T.IntegralType):
        raise TypeError(f"ids are whole numbers, {id_col} is {id_type.simpleString()}")
    bound_batches(docs.sparkSession)
    slim = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(text_col).cast("string").alias("text"),
        F.xxhash64(F.col(text_col).cast("string")).alias("text_hash"),
    )
    lines = shared_table(line_hashes(slim, min_chars), "line-hashes")
    gone = lost_lines(lines, build_index(lines), min_docs)
    same = [F.col(f"d.{c}").eqNullSafe(F.col(f"g.{c}")) for c in ("id", "text_hash")]
    joined = slim.alias("d").join(gone.alias("g"), same[0] & same[1], "left").select("d.id", "d.text", "g.gone")
    schema = arrow_schema(KEPT_SCHEMA)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, n_lines, n_gone = [], [], []
            for text, lost in zip(batch.column("text"), batch.column("gone"), strict=True):
                whole, away = text.as_py() or "", set(lost.as_py() or ())
                n_lines.append(whole.count("\n") + 1)
                n_gone.append(len(away))
                kept.append("\n".join(x for i, x in enumerate(whole.split("\n")) if i not in away) if away else whole)
            values = [batch.column("id"), pa.array(kept, pa.string()), pa.array(n_lines), pa.array(n_gone)]
            yield pa.RecordBatch.from_arrays([v.cast(f.type) for v, f in zip(values, schema, strict=True)], schema=schema)

    return joined.mapInArrow(cut, KEPT_SCHEMA).withColumnRenamed("id", id_col)
