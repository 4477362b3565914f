"""Merkle manifest: sweeps, positions, hostile rows, against a plain version."""

from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from churnlens.llm import merkle
from churnlens.llm.queries import merkle_digests


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(digests, k):
    """Root, and the (left, right) siblings of each digest."""
    levels = [list(digests)]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([h(*low[i : i + k]) for i in range(0, len(low), k)])
    proofs = []
    for i in range(len(digests)):
        steps = []
        for low in levels[:-1]:
            run = low[i // k * k : i // k * k + k]
            steps.append(("".join(run[: i % k]), "".join(run[i % k + 1 :])))
            i //= k
        proofs.append(steps)
    return levels[-1][0], proofs


def brute(rows, k=2):
    groups = defaultdict(list)
    for doc_id, lang, leaf in rows:
        groups[lang].append((doc_id is not None, doc_id or 0, leaf, doc_id))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    out, subs = [], []
    for g in order:
        groups[g].sort()
        subs.append(tree([x[2] for x in groups[g]], k))
    if not order:
        return []
    root, above = tree([s[0] for s in subs], k)
    for g, (sub, proofs), top in zip(order, subs, above, strict=True):
        for (_, _, leaf, doc_id), steps in zip(groups[g], proofs, strict=True):
            out.append((doc_id, leaf, sub, root, steps + top))
    return sorted(out, key=repr)


def found(df):
    rows = [(r["doc_id"], r["leaf"], r["subroot"], r["root"], [tuple(p) for p in r["proof"]]) for r in df.collect()]
    return sorted(rows, key=repr)


@pytest.mark.parametrize("k", [2, 3, 7])
@pytest.mark.parametrize("n", [1, 2, 3, 8, 29, 100])
def test_sweeps_of_one_subtree(n, k):
    digests = [h(str(i)) for i in range(n)]
    sub = merkle.Subtree(n, merkle.depth(n, k), k)
    nodes = sub.forward(digests)
    labels = [sub.label(level, j) for level, j, _ in nodes]
    assert labels == sorted(labels)
    root, proofs = tree(digests, k)
    assert (merkle.combined(nodes[-1][2]) if nodes else digests[0]) == root
    for linked, steps in zip(sub.backward(nodes, None), proofs, strict=True):
        got = []
        while linked:
            got.append(linked[:2])
            linked = linked[2]
        assert got == steps


@pytest.mark.parametrize("k, block", [(2, 4096), (2, 4), (3, 9)])
def test_against_plain_tree(spark, monkeypatch, k, block):
    monkeypatch.setattr(merkle, "BLOCK_LEAVES", block)
    langs = [None, "", "en", "en", "en", "de", "ü", "z"]
    rows = [(i, langs[i * i % 8], h(str(i))) for i in range(1, 150)]
    rows += [(None, "en", h("x")), (None, "en", h("w")), (5, "en", h("5")), (5, "en", h("5")), (900, "lone", h("l"))]
    df = spark.createDataFrame(rows, "doc_id long, lang string, leaf string").repartition(6)
    df = df.selectExpr("*", "1 as pos", "2 as grp", "3 as digest", "4 as n", "doc_id * 2 as block")
    result = merkle.manifest(df, carried=["pos", "block"], fan_out=k)
    assert found(result) == brute(rows, k)
    assert result.filter("pos <> 1 or block <> doc_id * 2").count() == 0
    assert result.filter(merkle.folded(F.col("leaf"), F.col("proof")) != F.col("root")).count() == 0


def test_one_leaf_and_none(spark):
    schema = "doc_id long, lang string, leaf string"
    assert merkle.manifest(spark.createDataFrame([], schema)).collect() == []
    one = [(3, None, h("a"))]
    assert found(merkle.manifest(spark.createDataFrame(one, schema))) == brute(one) == [(3, h("a"), h("a"), h("a"), [])]
    lone = [(i, str(i), h(str(i))) for i in range(5)]  # no group has two leaves
    assert found(merkle.manifest(spark.createDataFrame(lone, schema))) == brute(lone)
    with pytest.raises(ValueError, match="two children"):
        merkle.manifest(spark.createDataFrame(one, schema), fan_out=1)


def test_digests_of_hostile_documents(hostile, monkeypatch):
    from tests.llm.conftest import HOSTILE

    from zlib import crc32

    monkeypatch.setattr(merkle, "BLOCK_LEAVES", 4)
    chars = {i: i for i in range(0, 10, 2)}
    docs = hostile.withColumn("n_chars", F.when(F.col("doc_id") % 2 == 0, F.col("doc_id")))
    leaf = lambda d, t, g, s, n: h(*map(field, (d, s, g, n, t)))
    rows = [(d, t, g, s, chars.get(d)) for d, t, g, s in HOSTILE]
    proofs = {(d, x): (sub, root, steps) for d, x, sub, root, steps in brute([(r[0], r[2], leaf(*r)) for r in rows])}
    want = defaultdict(int)
    for d, t, g, s, n in rows:
        own = leaf(d, t, g, s, n)
        sub, root, steps = proofs[d, own]
        bad = d is not None and n is not None and crc32(str(d).encode()) % 7 == 0
        fold = leaf(d, t, g, s, n + 1) if bad else own
        for left, right in steps:
            fold = h(left, fold, right)
        want[d, own, sub, root, fold, fold == root] += 1
    got = defaultdict(int)
    for r in merkle_digests(docs).collect():
        got[r["doc_id"], r["leaf"], r["subroot"], r["root"], r["folded_root"], r["verified"]] += 1
    assert got == want
    assert any(not key[-1] for key in want)
