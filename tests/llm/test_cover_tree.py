"""Dual-tree search against brute force."""

from __future__ import annotations

import math

import numpy as np
import pytest

from churnlens.llm import cover_tree as ct


def brute(vectors, queries, k):
    out = []
    for q, x in vectors:
        if q not in queries:
            continue
        scores = [(-sum(a * b for a, b in zip(x, y, strict=True)), v) for v, y in vectors if v != q and len(x) == len(y)]
        out += [(q, r + 1, v, -s) for r, (s, v) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def test_every_point_is_covered():
    rng = np.random.default_rng(2)
    points = np.concatenate([rng.normal(0, 1, (500, 3)) + c for c in ((0, 0, 0), (20, 0, 0), (0, 30, 0))])
    root = ct.build(points, np.arange(len(points)))

    def walk(node):
        away = np.sqrt(((points[node.members] - node.centre) ** 2).sum(axis=1))
        assert away.max() <= node.radius + 1e-9
        below = [node.loose, *[c.members for c in node.children]]
        assert sorted(np.concatenate(below)) == sorted(node.members)
        for child in node.children:
            assert child.radius <= node.radius / 2 + 1e-9
            walk(child)

    assert root.children
    walk(root)


@pytest.mark.parametrize("seed", [1, 2])
def test_search_equals_brute_force(seed):
    rng = np.random.default_rng(seed)
    points = np.concatenate([rng.integers(-9, 9, (300, 4)) + c for c in ((0,) * 4, (90, 0, 0, 0), (0, -200, 9, 9))])
    points = np.concatenate([points, np.repeat(points[:1], 400, axis=0)])
    ids = rng.permutation(len(points)).astype(np.int64)
    vectors = list(zip(ids.tolist(), points.tolist(), strict=True))
    chosen = ids[::7]
    s = ct.Search(points[::7].astype(float), chosen, points.astype(float), ids, 5).run()
    found = [(int(q), r + 1, int(s.ids[i, r]), int(s.scores[i, r])) for i, q in enumerate(chosen) for r in range(5)]
    assert sorted(found) == brute(vectors, set(chosen.tolist()), 5)


def test_top_k_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(ct, "CANDIDATE_BLOCK", 60)
    monkeypatch.setattr(ct, "QUERY_BLOCK", 10)
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(0, 1, 6)], 1) for i in range(200)]
    rows += [(200 + i, [0.25] * 6, 0) for i in range(30)]
    rows += [(300, None, 0), (301, [1.0, None] * 3, 0), (302, [math.nan] * 6, 0), (303, [math.inf] * 6, 0), (304, [1.0, 2.0], 0)]
    rows += [(305, [], 0), (None, [9.0] * 6, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    vectors = ct.quantised(df, "vec_id", "embedding")
    found = sorted(tuple(r) for r in ct.top_k(vectors.filter("id % 10 = 0"), vectors, 5).collect())
    exact = [(r["id"], r["v"]) for r in vectors.collect()]
    assert {v for v, _ in exact}.isdisjoint({300, 301, 302, 303, None})
    assert found == brute(exact, {v for v, _ in exact if v % 10 == 0}, 5)
    none = vectors.filter("id < 0")
    assert ct.top_k(none, vectors, 5).count() == 0 and ct.top_k(vectors, none, 5).count() == 0


def test_scores_beyond_doubles(spark):
    big = 2**30
    df = spark.createDataFrame([(0, [big, 1]), (1, [big, 3]), (2, [big, 2])], "id long, v array<long>")
    found = sorted(tuple(r) for r in ct.top_k(df.filter("id = 0"), df, 2).collect())
    assert found == [(0, 1, 1, big * big + 3), (0, 2, 2, big * big + 2)]


def clusters(rng, n, dim, groups, spread):
    centres = rng.normal(0, 1, (groups, dim))
    return np.round(256 * (centres[rng.integers(0, groups, n)] + rng.normal(0, spread, (n, dim))))


def searched(points, k=5, every=50):
    ids = np.arange(len(points))
    s = ct.Search(points[::every], ids[::every], points, ids, k).run()
    want = points[::every] @ points.T
    want[np.arange(len(s.q)), ids[::every]] = -np.inf
    for i in range(len(s.q)):
        assert s.ids[i].tolist() == sorted(ids.tolist(), key=lambda j: (-want[i, j], j))[:k]
    return s, s.scored / (len(s.q) * len(points))


def test_clustered_vectors_are_mostly_pruned():
    rng = np.random.default_rng(8)
    s, share = searched(clusters(rng, 4000, 16, 40, 0.05))
    assert share < 0.1 and s.visited > 20


def test_random_unit_vectors_are_hardly_pruned_but_bounded():
    rng = np.random.default_rng(9)
    points = rng.normal(0, 1, (2000, 64))
    points = np.floor(256 * points / np.linalg.norm(points, axis=1)[:, None])
    s, share = searched(points)
    assert 0.5 < share < 1.1 and s.visited >= 2


def test_the_given_vectors_are_in_a_tree():
    pq = pytest.importorskip("pyarrow.parquet")
    rows = pq.read_table("/root/testdata/sf0.01/embeddings.parquet").column("embedding").to_pylist()
    points = np.floor(256 * np.array(rows))
    root = ct.build(points, np.arange(len(points)))
    assert sorted(np.concatenate([root.loose, *[c.members for c in root.children]])) == list(range(len(points)))
    s, share = searched(points)
    assert share <= 1.1  # 1 and the seeds: these are random unit vectors


def test_leaves_are_small_and_centres_apart():
    rng = np.random.default_rng(10)
    points = clusters(rng, 3000, 4, 30, 0.2)

    def walk(node):
        assert len(node.members) > ct.LEAF or not node.children
        away = np.sqrt(((points[node.loose] - node.centre) ** 2).sum(axis=1))
        assert np.allclose(away, node.away, atol=1e-6)
        centres = [c.centre for c in node.children]
        for i, x in enumerate(centres):
            assert all(np.sqrt(((x - y) ** 2).sum()) > node.radius / 2 - 1e-6 for y in centres[:i])
        for child in node.children:
            walk(child)
        return 1 + max((0, *[walk(c) for c in node.children]))

    assert walk(ct.build(points, np.arange(len(points)))) >= 3


def test_components_beyond_64_bits_fail_clearly(spark):
    df = spark.createDataFrame([(0, [1e30, 1.0]), (1, [1.0, 2.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="does not fit into 64 bits"):
        ct.quantised(df, "vec_id", "embedding").collect()
    huge = spark.createDataFrame([(0, [2**62, 5]), (1, [2**62, 7])], "id long, v array<long>")
    with pytest.raises(Exception, match="does not fit into 64 bits"):
        ct.top_k(huge, huge, 1).collect()


def test_repeated_ids_are_vectors_of_their_own(spark):
    df = spark.createDataFrame([(0, [3, 1]), (0, [9, 9]), (1, [2, 2]), (1, [2, 2]), (2, [1, 0])], "id long, v array<long>")
    found = [tuple(r) for r in ct.top_k(df.filter("id = 0 and v[0] = 3"), df, 5).collect()]
    assert sorted(found) == [(0, 1, 1, 8), (0, 2, 1, 8), (0, 3, 2, 3)]
