"""Content sort: groups, the row that stays, and hot texts."""

from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from churnlens.llm import content_sort


def brute(rows, keep):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[text or ""].append(doc_id)
    pick = min if keep == "min" else max
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        best, left = (pick(known) if known else None), 1
        for i in ids:
            kept = i == best and left
            left -= bool(kept)
            out.append((i, best, len(ids), bool(kept), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("keep", ["min", "max"])
def test_hostile(hostile, keep):
    from tests.llm.conftest import HOSTILE

    assert result(content_sort.exact_duplicates(hostile, keep=keep)) == brute(HOSTILE, keep)


def test_frequent_texts_are_cut_and_stitched(documents, monkeypatch):
    monkeypatch.setattr(content_sort, "SALTS", 7)
    head = "the same first words in every document of this frequent beginning, always "
    rows = [(i, head + str(i % 40), "en", "a") for i in range(800)] + [(1000 + i, "hot", "en", "a") for i in range(300)]
    for keep in ("min", "max"):
        df = documents(rows).repartition(5)
        assert result(content_sort.exact_duplicates(df, keep=keep)) == brute(rows, keep)
        kept = content_sort.drop_exact_duplicates(df, keep=keep)
        assert sorted(r["doc_id"] for r in kept.collect()) == sorted(r[0] for r in brute(rows, keep) if r[3])
        assert kept.columns == df.columns


def test_normalised_and_empty(documents, nothing):
    rows = [(1, "A b", "en", "x"), (2, "a  B", "en", "x")]
    norm = lambda t: F.lower(F.regexp_replace(t, " +", " "))
    assert [r["group_size"] for r in content_sort.exact_duplicates(documents(rows), normalise=norm).collect()] == [2, 2]
    assert content_sort.exact_duplicates(nothing).count() == 0
    assert content_sort.drop_exact_duplicates(nothing).count() == 0


def test_plan_sorts_once_and_stays_native(hostile):
    df = content_sort.sorted_runs(content_sort.packed(hostile, "doc_id", "text", hostile.columns), None, "min")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange rangepartitioning") == 1 and plan.count("Exchange") == 1
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_columns_named_like_internal_ones_come_back_unchanged(documents):
    rows = [(i, ["a", "b", None][i % 3], "en", "x") for i in range(30)]
    names = [content_sort._ID, "__value", "__row", *content_sort._RUN, content_sort._DIGEST, content_sort._RANK, "__size", "a.b"]
    df = documents(rows).select("doc_id", "text", *[F.concat(F.lit(f"{n}-"), "doc_id").alias(n) for n in names])
    kept = content_sort.drop_exact_duplicates(df, keep="max").collect()
    assert kept and all(r[n] == f"{n}-{r['doc_id']}" for r in kept for n in names)
    assert sorted(r["doc_id"] for r in kept) == [27, 28, 29] and kept[0].__fields__ == df.columns
    odd = df.withColumnsRenamed({"doc_id": "__rank2", "text": "__text2"}).select(
        F.col("__rank2").alias("__salt"), F.col("__text2").alias("__prefix"), F.col("__text").alias("mine")
    )
    found = content_sort.exact_duplicates(odd, "__salt", "__prefix", keep="max")
    assert found.columns[0] == "__salt" and found.filter("kept").count() == 3
