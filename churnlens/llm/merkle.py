"""Merkle dataset manifest by time-forward processing.

Leaves stand in order within their group (a language, say); every ``fan_out``
consecutive nodes become one, level by level, down to one subroot a group, and
the subroots in the same way to the root. Two sweeps do all of it:

* forward: nodes are taken by their label (the last leaf below them, then the
  level), and each sends its digest to its parent through a priority queue
  ordered by label, so that a parent finds all its children's digests at the
  head of the queue when its turn comes;
* reversed: in falling order of the labels every node sends each child the
  proof suffix that leads from there to the root.

The queue is external: Spark's sort and shuffle carry the messages between
blocks of ``fan_out ** k`` (about BLOCK_LEAVES) nodes, which are whole subtrees,
and a heap of a few messages a level carries them within one. A round turns
blocks into the leaves of the next round, so N leaves take log(N) / log(4096)
rounds up and as many down: two for 16 million, four for 10^14. Positions come
from one range-partitioned sort and sums over its partitions: a group may hold
most of the rows, and no task sees more than its range or its block.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlens.llm.common import shared_table

#: Nodes that one task call turns into one, at most.
BLOCK_LEAVES = 4096

PROOF = "array<struct<left:string,right:string>>"


def field_text(column: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:`` and the value."""
    text = column.cast("string")
    return F.when(column.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(columns: Sequence[Column]) -> Column:
    return F.sha2(F.encode(F.concat(*[field_text(c) for c in columns]), "UTF-8"), 256)


def folded(digest: Column, proof: Column) -> Column:
    """The root that ``proof`` leads ``digest`` to."""
    return F.aggregate(
        proof, digest, lambda d, p: F.sha2(F.encode(F.concat(p["left"], d, p["right"]), "UTF-8"), 256)
    )


def proof_text(proof: Column) -> Column:
    """All sibling digests, level by level, left to right."""
    return F.array_join(F.transform(proof, lambda p: F.concat(p["left"], p["right"])), "")


def combined(digests: Sequence[str]) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


@dataclass
class Subtree:
    """``m`` nodes that become one within ``levels`` levels."""

    m: int
    levels: int
    fan_out: int

    def label(self, level: int, j: int) -> tuple[int, int]:
        """The node's time: its last leaf, then its level."""
        return min((j + 1) * self.fan_out**level, self.m) - 1, level

    def forward(self, digests: Sequence[str]) -> list[tuple[int, int, list[str]]]:
        """Inner nodes in the order of their labels: level, number, children's digests."""
        queue: list[tuple[tuple[int, int], int, str]] = []  # label of the receiver, child, digest
        nodes: list[tuple[int, int, list[str]]] = []

        def send(level: int, j: int, digest: str) -> None:
            if level < self.levels:
                heapq.heappush(queue, (self.label(level + 1, j // self.fan_out), j, digest))

        for time, digest in enumerate(digests):
            send(0, time, digest)
            while queue and queue[0][0][0] <= time:
                at, first, digest = heapq.heappop(queue)
                children = [digest]
                while queue and queue[0][0] == at:
                    children.append(heapq.heappop(queue)[2])
                node = (at[1], first // self.fan_out, children)
                nodes.append(node)
                send(node[0], node[1], combined(children))
        return nodes

    def backward(self, nodes: Sequence[tuple[int, int, list[str]]], suffix: tuple | None) -> list[tuple | None]:
        """Proof of each leaf, as linked (left, right, rest); ``suffix`` is the subtree's own."""
        proofs: list[tuple | None] = [suffix] * self.m
        queue = [((-self.m + 1, -self.levels), suffix)] if self.levels else []
        for level, j, children in reversed(nodes):
            _, own = heapq.heappop(queue)  # the receiver with the largest label: this node
            for i in range(len(children)):
                proof = ("".join(children[:i]), "".join(children[i + 1 :]), own)
                child = j * self.fan_out + i
                if level == 1:
                    proofs[child] = proof
                else:
                    time, at = self.label(level - 1, child)
                    heapq.heappush(queue, ((-time, -at), proof))
        return proofs


def depth(n: int, fan_out: int) -> int:
    """Levels until ``n`` nodes are one."""
    levels = 0
    while n > 1:
        n, levels = -(-n // fan_out), levels + 1
    return levels


def block_levels(n: int, fan_out: int) -> int:
    """Levels of a block among ``n`` nodes: all there are, if one block holds them."""
    whole = max(1, round(math.log(BLOCK_LEAVES, fan_out)))
    return min(whole, depth(n, fan_out))


def block_size(fan_out: int) -> int:
    return fan_out ** max(1, round(math.log(BLOCK_LEAVES, fan_out)))


def positions(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Adds ``pos`` (from 0, ascending by ``order``, nulls first) and ``n`` (their count) within each ``grp``.

    ``rows`` is a stored table. Rows alike in ``order`` take any of their places.
    """
    keys = ["grp", *order, "salt"]
    ranged = rows.withColumn("salt", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    stored = shared_table(ranged.drop("salt").withColumn("at", F.monotonically_increasing_id()), "merkle-order")
    part = F.shiftright("at", 33)
    counts = stored.groupBy("grp", part.alias("part")).agg(F.count(F.lit(1)).alias("rows"), F.min("at").alias("first"))
    before = Window.partitionBy("grp").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(
        "grp",
        "part",
        "first",
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("base"),
        F.sum("rows").over(Window.partitionBy("grp")).alias("n"),
    )
    numbered = stored.withColumn("part", part).join(bases, ["grp", "part"])
    return numbered.withColumn("pos", F.col("base") + F.col("at") - F.col("first")).drop("part", "first", "base", "at")


def _levels(table: pa.Table, fan_out: int) -> Subtree:
    return Subtree(table.num_rows, block_levels(table.column("n")[0].as_py(), fan_out), fan_out)


def sweep_forward(leaves: DataFrame, fan_out: int) -> list[DataFrame]:
    """Tables (grp, pos, n, digest) of each round: the leaves, the blocks' digests, ... one row a group."""
    size = block_size(fan_out)

    def rise(key: tuple, block: pa.Table) -> pa.Table:
        block = block.sort_by("pos")
        tree, digests = _levels(block, fan_out), block.column("digest").to_pylist()
        nodes = tree.forward(digests)
        top = combined(nodes[-1][2]) if nodes else digests[0]
        n = -(-block.column("n")[0].as_py() // size)
        return pa.table({"grp": [key[0].as_py()], "pos": [key[1].as_py()], "n": [n], "digest": [top]})

    rounds = [leaves]
    most = leaves.agg(F.max("n")).first()[0] or 1
    while most > 1:
        blocks = rounds[-1].select("grp", F.expr(f"pos div {size}").alias("block"), "pos", "n", "digest")
        risen = blocks.groupBy("grp", "block").applyInArrow(rise, "grp string, pos long, n long, digest string")
        rounds.append(shared_table(risen, "merkle-round"))
        most = -(-most // size)
    return rounds


def sweep_reversed(rounds: list[DataFrame], tops: DataFrame, fan_out: int) -> DataFrame:
    """The leaves (first of ``rounds``) with subroot and proof.

    ``tops`` has grp, pos (0), subroot and proof (its suffix) of every group.
    """
    size = block_size(fan_out)
    proof_type = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))

    def fall(block: pa.Table, above: pa.Table) -> pa.Table:
        block = block.sort_by("pos")
        tree = _levels(block, fan_out)
        suffix = None
        for step in reversed(above.column("proof")[0].as_py()):
            suffix = (step["left"], step["right"], suffix)
        lefts, rights, ends = [], [], [0]
        for proof in tree.backward(tree.forward(block.column("digest").to_pylist()), suffix):
            while proof is not None:
                left, right, proof = proof
                lefts.append(left)
                rights.append(right)
            ends.append(len(lefts))
        steps = pa.StructArray.from_arrays([pa.array(lefts, pa.string()), pa.array(rights, pa.string())], ["left", "right"])
        proofs = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), steps).cast(proof_type)
        subroot = pa.array([above.column("subroot")[0].as_py()] * block.num_rows, pa.string())
        return block.drop_columns(["block"]).append_column("subroot", subroot).append_column("proof", proofs)

    below = tops
    for nodes in reversed(rounds[:-1]):
        blocks = nodes.withColumn("block", F.expr(f"pos div {size}"))
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema)
        above = below.select("grp", F.col("pos").alias("block"), "subroot", "proof")
        met = blocks.groupBy("grp", "block").cogroup(above.groupBy("grp", "block"))
        below = met.applyInArrow(fall, f"{schema}, subroot string, proof {PROOF}")
    if len(rounds) == 1:  # no group has two leaves
        below = rounds[0].join(tops.drop("pos"), "grp")
    return below


def manifest(
    leaves: DataFrame,
    leaf_col: str = "leaf",
    group_col: str = "lang",
    id_col: str = "doc_id",
    carried: Sequence[str] = (),
    fan_out: int = 2,
) -> DataFrame:
    """One row per leaf: id, ``carried`` columns, leaf, subroot, root and proof.

    ``leaf_col`` holds the digests (lowercase hex). Within a group leaves
    ascend by id (nulls first, ties by digest); groups ascend by UTF-8 bytes,
    null first, and null is a group apart from the empty text. While several
    nodes remain, every ``fan_out`` consecutive ones become the sha256 of
    their joined digests, the last run with fewer, even one; a lone leaf is
    its group's subroot, a lone subroot the root. ``proof`` lists, level by
    level from the leaf to the root, the digests left and right of the path.
    Repeated rows are leaves of their own. An empty table gives an empty
    result; other columns are ignored, whatever their names.
    """
    if fan_out < 2:
        raise ValueError("a node has two children at least")
    group = F.col(group_col).cast("string")
    stored = shared_table(
        leaves.select(
            F.when(group.isNull(), "").otherwise(F.concat(F.lit("="), group)).alias("grp"),
            F.col(id_col).alias("id"),
            F.col(leaf_col).alias("digest"),
            F.struct(F.lit(0).alias("_"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(carried)]).alias("payload"),
        ),
        "merkle-leaves",
    )
    rounds = sweep_forward(shared_table(positions(stored, ["id", "digest"]), "merkle-round"), fan_out)
    subroots = rounds[-1].select("grp", F.col("digest").alias("subroot"))
    ranked = positions(subroots.select(F.lit("").alias("grp"), F.col("grp").alias("id"), F.col("subroot").alias("digest")), ["id"])
    above = sweep_forward(shared_table(ranked, "merkle-round"), fan_out)
    root = above[-1].select("digest").first()  # one row
    top = above[-1].select("grp", "pos", F.lit("").alias("subroot"), F.array().cast(PROOF).alias("proof"))
    proved = sweep_reversed(above, top, fan_out)
    tops = shared_table(
        proved.select(F.col("id").alias("grp"), F.lit(0).cast("long").alias("pos"), F.col("digest").alias("subroot"), "proof"),
        "merkle-subroots",
    )
    found = sweep_reversed(rounds, tops, fan_out)
    return found.select(
        F.col("id").alias(id_col),
        *[F.col(f"payload.c{i}").alias(c) for i, c in enumerate(carried)],
        F.col("digest").alias("leaf"),
        "subroot",
        F.lit(root[0] if root else None).cast("string").alias("root"),
        "proof",
    )
