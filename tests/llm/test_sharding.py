"""Vector bin packing: balance, whole groups, gapless slots."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pytest

from churnlens.llm import sharding


def check(rows, found, n):
    assert len(found) == len(rows)
    for s in {r["shard"] for r in found}:
        assert sorted(r["slot"] for r in found if r["shard"] == s) == list(range(sum(r["shard"] == s for r in found)))
        assert 0 <= s < n
    want = sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t, *_ in rows)
    assert sorted((r["size"], r["text_crc32"]) for r in found) == want


def test_balance_and_groups(documents):
    rng = np.random.default_rng(1)
    texts = ["w " * int(k) + str(i) for i, k in enumerate(rng.pareto(2.5, 1500) * 8 + 1)]
    rows = [(i, texts[int(rng.integers(0, len(texts)))], "en", "a") for i in range(3000)]
    found = sharding.shard_documents(documents(rows), 8).collect()
    check(rows, found, 8)
    by_id = {r["doc_id"]: r["shard"] for r in found}
    groups = {}
    for i, text, *_ in rows:
        groups.setdefault(text, set()).add(by_id[i])
    assert all(len(s) == 1 for s in groups.values())
    load = np.zeros((8, 3))
    for r in found:
        load[r["shard"]] += (r["size"], r["tokens"], 1)
    assert load[:, 0].max() / load[:, 0].min() < 1.02
    assert load[:, 2].max() / load[:, 2].min() < 1.10


def test_a_group_larger_than_a_shard_is_cut(documents):
    rows = [(i, "hot text", "en", "a") for i in range(400)] + [(1000 + i, f"other {i}", "en", "a") for i in range(400)]
    found = sharding.shard_documents(documents(rows), 4).collect()
    check(rows, found, 4)
    sizes = [sum(r["size"] for r in found if r["shard"] == s) for s in range(4)]
    assert max(sizes) / min(sizes) < 1.25


def test_hostile_and_empty(hostile, nothing):
    from tests.llm.conftest import HOSTILE

    check(HOSTILE, sharding.shard_documents(hostile, 3).collect(), 3)
    assert sharding.shard_documents(nothing, 3).count() == 0


def test_pack_places_where_the_dot_product_is_highest():
    items = np.array([[8, 0, 1], [0, 8, 1], [8, 0, 1], [0, 8, 1]], dtype=float)
    shards = sharding.pack(items, 2)
    assert shards[0] != shards[2] and shards[1] != shards[3]


def plain_pack(items, n):
    """Largest need first; the shard with room whose residual capacity has the highest dot product."""
    dims = range(3)
    capacity = [sum(v[d] for v in items) / n for d in dims]
    need = [[v[d] / capacity[d] if capacity[d] else 0.0 for d in dims] for v in items]
    residual, where = [[1.0] * 3 for _ in range(n)], [0] * len(items)
    for i in sorted(range(len(items)), key=lambda i: (-max(need[i]), i)):
        room = [s for s in range(n) if all(residual[s][d] >= need[i][d] for d in dims)]
        score = {s: sum(residual[s][d] * need[i][d] for d in dims) for s in room} or {s: residual[s][0] for s in range(n)}
        where[i] = max(score, key=lambda s: (score[s], -s))
        residual[where[i]] = [residual[where[i]][d] - need[i][d] for d in dims]
    return where


def test_packing_equals_a_plain_packer():
    rng = np.random.default_rng(12)
    for n in (2, 5, 8):
        # powers of two keep the sums exact, so ties are ties in both
        items = 2.0 ** rng.integers(0, 9, (500, 3))
        assert sharding.pack(items, n).tolist() == plain_pack(items.tolist(), n)


def test_shards_and_slots_equal_a_plain_version(documents):
    rng = np.random.default_rng(13)
    rows = [(int(i), f"t{rng.integers(0, 500)} " * int(rng.integers(1, 20)), "en", "a") for i in rng.permutation(700)]
    rows += [(5000, None, "en", "a"), (5001, "", "en", "a"), (None, "no id", "en", "a")]
    groups = {}
    for i, text, *_ in rows:
        raw = (text or "").encode()
        groups.setdefault("g:" + hashlib.sha256(raw).hexdigest().upper() + ":0", []).append((i, raw))
    names = sorted(groups)
    items = [[sum(len(r) + 1 for _, r in groups[g]), sum(len(r.split()) for _, r in groups[g]), len(groups[g])] for g in names]
    want = {}
    for shard, g in zip(sharding.pack(np.array(items, dtype=float), 6).tolist(), names, strict=True):
        for i, raw in groups[g]:
            want.setdefault(shard, []).append((i is not None, i or 0, zlib.crc32(raw), len(raw) + 1))
    expected = {(s, slot, r[2]) for s, own in want.items() for slot, r in enumerate(sorted(own))}
    found = sharding.shard_documents(documents(rows), 6).collect()
    assert {(r["shard"], r["slot"], r["text_crc32"]) for r in found} == expected and len(found) == len(rows)


def test_an_id_named_like_a_result_column_raises(documents):
    with pytest.raises(ValueError, match="rename the id"):
        sharding.shard_documents(documents([(1, "a", "en", "a")]).withColumnRenamed("doc_id", "tokens"), 2, "tokens")
