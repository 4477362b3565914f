"""Exact top-k by inner product: dual-tree search over cover trees.

Candidates and queries are dealt into hash blocks; each (query block,
candidate block) pair is one bounded task. The task indexes both sides in
cover trees over Euclidean distance: the children of a node have centres more
than half its radius apart, every point joins the nearest one, and points that
a child would hold fewer than LEAF of stay in the node, each with its own
distance from the centre. The search walks pairs of nodes. For any q within
``rq`` of a query centre and any c at distance ``d`` from a candidate centre,

    q . c <= qc . cc + |qc| d + |cc| rq + rq d,

so a pair of nodes (``d`` the candidate node's radius) or a single candidate
(``d`` its own distance) is pruned when that bound is below the worst kth score
of the query node's members. Each query first scores the leaf it falls in, so
that thresholds are there from the start; the candidates that are left of a
leaf are scored as one matrix product.

How much is pruned is up to the vectors: on clustered ones a small share of
the pairs is scored (``Search.scored``), on random unit vectors of many
dimensions, where all points are about equally far apart, nearly all of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CANDIDATE_BLOCK = 8192
QUERY_BLOCK = 2048
#: A node with no more points than this is not divided, and a child has more.
LEAF = 16
#: Points that are tried as centres at once, and distances taken at once.
CENTRES = 64
CELLS = 1 << 20
#: Scores stay exact in doubles below this, and in 64 bits up to the other.
EXACT = float(2**53)
LARGEST = 2**63 - 1


@dataclass
class Node:
    """Points ``members`` lie within ``radius`` of ``centre``; ``loose`` are those
    that are leaves themselves, at distances ``away``; the rest is in ``children``."""

    members: np.ndarray
    centre: np.ndarray
    radius: float
    children: list[Node] = field(default_factory=list)
    loose: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    away: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def __post_init__(self):
        self.norm = float(np.sqrt((self.centre**2).sum()))


def _squared(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances (points, centres)."""
    found = (points**2).sum(axis=1)[:, None] - 2 * (points @ centres.T) + (centres**2).sum(axis=1)
    return np.maximum(found, 0.0)


def separated(points: np.ndarray, apart: float) -> np.ndarray:
    """Places of centres that are over ``apart`` from each other and within it of every point."""
    left, chosen, limit = np.arange(len(points)), [], apart * apart
    while len(left):
        tried = left[:CENTRES]
        near = _squared(points[tried], points[tried]) <= limit
        own: list[int] = []
        for i in range(len(tried)):
            if not near[i, own].any():
                own.append(i)
        chosen.append(tried[own])
        covered = (_squared(points[left], points[tried[own]]) <= limit).any(axis=1)
        covered[: len(tried)] = True  # all of these are, whatever rounding says
        left = left[~covered]
    return np.concatenate(chosen) if chosen else left


def build(points: np.ndarray, members: np.ndarray) -> Node:
    """Cover tree over ``points[members]``: children cover half the parent's radius."""
    centre = points[members[0]]
    away = np.sqrt(((points[members] - centre) ** 2).sum(axis=1))
    node = Node(members, centre, float(away.max()))
    if len(members) <= LEAF or node.radius == 0:
        node.loose, node.away = members, away
        return node
    own = points[members]
    centres = separated(own, node.radius / 2)
    nearest = np.empty(len(members), dtype=np.int64)
    nearest[centres] = np.arange(len(centres))
    others = np.setdiff1d(np.arange(len(members)), centres)
    rows = max(1, CELLS // len(centres))
    for at in range(0, len(others), rows):
        some = others[at : at + rows]
        nearest[some] = _squared(own[some], own[centres]).argmin(axis=1)
    large = np.bincount(nearest, minlength=len(centres)) > LEAF
    stays = ~large[nearest]
    node.loose, node.away = members[stays], away[stays]
    for k in np.flatnonzero(large):
        mine = members[nearest == k]
        first = members[centres[k]]
        node.children.append(build(points, np.concatenate([[first], mine[mine != first]])))
    return node


class Search:
    """Top-k of each query in one block of candidates.

    ``scored`` counts the products taken, ``visited`` the pairs of nodes met.
    """

    def __init__(self, queries, query_ids, candidates, candidate_ids, k: int):
        order = np.argsort(candidate_ids, kind="stable")  # of equal scores the first place has the smallest id
        self.c, self.c_ids = candidates[order], candidate_ids[order]
        self.q, self.q_ids, self.k = queries, query_ids, k
        self.scores = np.full((len(queries), k), -np.inf)
        self.at = np.full((len(queries), k), len(candidates))  # places of the best candidates
        self.scored = self.visited = 0

    @property
    def ids(self) -> np.ndarray:
        return np.append(self.c_ids, np.iinfo(np.int64).max)[self.at]

    def run(self) -> Search:
        if len(self.q) and len(self.c):
            self.length = np.sqrt((self.q**2).sum(axis=1))
            top = build(self.c, np.arange(len(self.c)))
            self.seed(np.arange(len(self.q)), top)
            self.visit(build(self.q, np.arange(len(self.q))), top)
        return self

    def seed(self, rows: np.ndarray, node: Node) -> None:
        """Each query scores some points of the leaf that it falls in."""
        while node.children:
            gain = self.q[rows] @ np.array([x.centre for x in node.children]).T
            best = gain.argmax(axis=1)
            if len(np.unique(best)) > 1:
                for i in np.unique(best):
                    self.seed(rows[best == i], node.children[i])
                return
            node = node.children[best[0]]
        self.score(rows, node.loose[: max(LEAF, 2 * self.k)])

    def visit(self, a: Node, b: Node) -> None:
        """Pairs of nodes, until the queries are a leaf."""
        self.visited += 1
        most = float(a.centre @ b.centre) + a.norm * b.radius + b.norm * a.radius + a.radius * b.radius
        if _safe(most) < self.scores[a.members, -1].min():
            return
        if not a.children:
            self.descend(a.members, b)
        elif a.radius > b.radius or not b.children:
            if len(a.loose):
                self.visit(Node(a.loose, a.centre, float(a.away.max()), [], a.loose, a.away), b)
            for child in a.children:
                self.visit(child, b)
        else:
            for child in _best_first(a.centre, a.norm, b.children):
                self.visit(a, child)
            if len(b.loose):
                self.visit(a, Node(b.loose, b.centre, float(b.away.max()), [], b.loose, b.away))

    def descend(self, rows: np.ndarray, b: Node) -> None:
        """A leaf's queries, each with its own bound, down the candidates' tree."""
        self.visited += 1
        middle = self.q[rows] @ b.centre
        rows, middle = self.open(rows, middle, middle + self.length[rows] * b.radius)
        if not len(rows):
            return
        for child in _best_first(self.q[rows].mean(axis=0), float(self.length[rows].mean()), b.children):
            self.descend(rows, child)
        if len(b.loose):
            loose, away = b.loose, b.away
            if b.radius == 0:  # copies of one vector: only the smallest ids can rank
                loose, away = loose[: self.k + 1], away[: self.k + 1]
            most = _safe(middle[:, None] + self.length[rows][:, None] * away[None, :])
            wanted = most >= self.scores[rows, -1:]
            some, points = wanted.any(axis=1), wanted.any(axis=0)
            if some.any():
                self.score(rows[some], loose[points])

    def open(self, rows: np.ndarray, middle: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        kept = _safe(most) >= self.scores[rows, -1]
        return rows[kept], middle[kept]

    def score(self, rows: np.ndarray, members: np.ndarray) -> None:
        for at in range(0, len(members), 512):
            some = members[at : at + 512]
            found = self.q[rows] @ self.c[some].T
            self.scored += found.size
            found[self.q_ids[rows][:, None] == self.c_ids[some][None, :]] = -np.inf
            hit = (found >= self.scores[rows, -1:]).any(axis=1)
            if not hit.any():
                continue
            who, found = rows[hit], found[hit]
            # a seed is met again: it counts once
            found[(self.at[who][:, :, None] == some[None, None, :]).any(axis=1)] = -np.inf
            scores = np.concatenate([self.scores[who], found], axis=1)
            places = np.concatenate([self.at[who], np.broadcast_to(some, found.shape)], axis=1)
            places[scores == -np.inf] = len(self.c)
            top = np.lexsort((places, -scores), axis=1)[:, : self.k]
            self.scores[who] = np.take_along_axis(scores, top, 1)
            self.at[who] = np.take_along_axis(places, top, 1)


def _safe(bound):
    """A bound that rounding cannot have made too small."""
    return bound + np.abs(bound) * 1e-9 + 1e-6


def _best_first(centre: np.ndarray, norm: float, children: list[Node]) -> list[Node]:
    return sorted(children, key=lambda x: -(float(centre @ x.centre) + norm * x.radius))


def _search_block(k: int):
    def run(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vec_id": [], "score": []}
        for dim, own in queries.groupby(queries["v"].str.len()):
            others = candidates[candidates["v"].str.len() == dim]
            if not len(others):
                continue
            q, c = (np.array(x["v"].tolist(), dtype=np.int64).reshape(len(x), dim) for x in (own, others))
            largest = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(dim, 1)
            if largest < EXACT:
                q, c = q.astype(float), c.astype(float)
                s = Search(q, own["id"].to_numpy(), c, others["id"].to_numpy(), k).run()
            else:
                s = _exhaustive(q, own["id"].to_numpy(), c, others["id"].to_numpy(), k)
            real = s.ids != np.iinfo(np.int64).max
            real &= s.scores != -np.inf
            out["query_id"].append(np.repeat(own["id"].to_numpy(), real.sum(axis=1)))
            out["vec_id"].append(s.ids[real])
            out["score"].append(s.scores[real].astype(np.int64))
        return pd.DataFrame({x: np.concatenate(v) if v else np.array([], np.int64) for x, v in out.items()})

    return run


def _exhaustive(q, q_ids, c, c_ids, k: int) -> Search:
    """Scores too large for exact doubles: integer arithmetic, no bounds."""
    s = Search(q.astype(object), q_ids, c.astype(object), c_ids, k)
    s.scores = np.full((len(q), k), -np.inf, dtype=object)
    for i in range(len(q)):
        found = (s.c @ s.q[i]).astype(object)
        keep = [j for j in range(len(s.c)) if s.c_ids[j] != q_ids[i]]
        keep = sorted(keep, key=lambda j: (-found[j], j))[:k]
        if any(abs(int(found[j])) > LARGEST for j in keep):
            raise OverflowError(f"a score of vector {int(q_ids[i])} does not fit into 64 bits")
        s.scores[i, : len(keep)] = [found[j] for j in keep]
        s.at[i, : len(keep)] = keep
    return s


def quantised(vectors: DataFrame, id_col: str, vec_col: str, scale: int = 256) -> DataFrame:
    """(id, v array<long>): floor(scale * x); rows with null or non-finite parts go.

    A finite part that does not fit into 64 bits then fails the query. Rows
    that repeat an id are vectors of their own, and none of them is a
    candidate of a query with that id; repeated equal ones both rank.
    """
    x = F.transform(vec_col, lambda e: e.cast("double"))
    message = F.lit("a vector's part is too large: scaled, it does not fit into 64 bits")
    whole = lambda e: F.when(F.abs(e * scale) < 2.0**63, F.floor(e * scale)).otherwise(F.raise_error(message))
    fine = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    return vectors.filter(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & fine).select(
        F.col(id_col).cast("long").alias("id"), F.transform(x, whole).alias("v")
    )


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, rank int, vec_id, score long) of integer vectors (id, v).

    Every candidate with another id takes part; ties go to the smaller id, and
    vectors are compared with those of equal length only. A query without
    candidates has no rows; an empty side gives an empty result.
    """
    n_c = max(1, math.ceil(candidates.count() / CANDIDATE_BLOCK))
    n_q = max(1, math.ceil(queries.count() / QUERY_BLOCK))

    def dealt(df: DataFrame, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        blocks = F.explode(F.sequence(F.lit(0), F.lit(n_other - 1)))
        return df.select("id", "v", F.pmod(F.xxhash64("id", "v"), F.lit(n_own)).cast("int").alias(own), blocks.alias(other))

    q = dealt(queries, "qb", n_q, "cb", n_c)
    c = dealt(candidates, "cb", n_c, "qb", n_q)
    found = (
        q.groupBy("qb", "cb")
        .cogroup(c.groupBy("qb", "cb"))
        .applyInPandas(_search_block(k), "query_id long, vec_id long, score long")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
