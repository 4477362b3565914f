"""Line dedup: perfect hashes, hostile rows, frequent lines, against a plain version."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pytest

from churnlens.llm import line_dedup

SPACE = " \t\n\x0b\x0c\r"
A_TO_Z = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def brute(rows, min_docs=5, min_chars=40):
    least = line_dedup.NO_ID
    keys = lambda text: [x.strip(SPACE).translate(A_TO_Z) for x in (text or "").split("\n")]
    held = defaultdict(list)
    for doc_id, text, *_ in rows:
        for key in set(keys(text)):
            if len(key) >= min_chars:
                held[key].append(least if doc_id is None else doc_id)
    out = []
    for doc_id, text, *_ in rows:
        lines, own = (text or "").split("\n"), least if doc_id is None else doc_id
        kept = [x for x, k in zip(lines, keys(text), strict=True) if len(held[k]) < min_docs or max(held[k]) == own]
        out.append((doc_id, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_perfect_hash_is_minimal():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 1000, 30_000):
        h1, h2 = rng.integers(0, 1 << 63, (2, n), dtype=np.uint64)
        h1[: n // 2] = h1[:1]  # halves may be equal as long as pairs differ
        found = line_dedup.PerfectHash.of(h1, h2)
        assert sorted(found.slots(h1, h2).tolist()) == list(range(n))
        assert 64 * len(found.words) <= 64 * len(found.sizes) + 8 * n
    with pytest.raises(ValueError, match="distinct"):
        line_dedup.PerfectHash.of(h1[:1].repeat(2), h2[:1].repeat(2))


def test_arrays_know_what_was_not_indexed():
    rng = np.random.default_rng(4)
    h1, h2 = rng.integers(-(1 << 62), 1 << 62, (2, 20_000))
    n, last = np.arange(10_000) % 700 + 1, np.arange(10_000) - 5000
    arrays = line_dedup.LineArrays(line_dedup.shard_row(0, h1[:10_000], h2[:10_000], n, last, 10**9))
    counts, lasts = arrays.probe(h1, h2)
    assert (counts[:10_000] == n).all() and (lasts[:10_000] == last).all()
    assert (counts[10_000:] == 0).all()  # the 32-bit fingerprints let one in 4 billion through


def test_keys_count_code_points():
    key = lambda x, n: line_dedup.line_key(x.encode(), n)
    assert key(" \t" + "é" * 40 + "\r", 40) == ("é" * 40).encode()
    assert key("é" * 39, 40) is None and key("😀" * 39, 40) is None and key("😀" * 40, 40) is not None
    assert key("ÀB", 2) == "Àb".encode()  # only A-Z are lowered
    assert key("", 0) == b""


LONG_LINE = "This line is long enough to be counted by all means"


@pytest.mark.parametrize("hot", [1, 20, 4096])
def test_against_brute_force(documents, hostile, monkeypatch, hot):
    from tests.llm.conftest import HOSTILE

    monkeypatch.setattr(line_dedup, "HOT", hot)  # 1: no line is frequent; 4096: all are
    rows = [(i, f"own line number {i} which nobody else in this table has\n {LONG_LINE}\t\nshort", "en", "a") for i in range(60)]
    rows += [(100 + i, f"{LONG_LINE.upper()}\nx\n{LONG_LINE}\n\n" + "seldom repeated, but long enough to count" * (i < 5), "en", "a") for i in range(9)]
    rows += [(300 + i, "held by four documents, so it stays in all of them", "en", "a") for i in range(4)]
    rows += [(7, "\n" + LONG_LINE, "en", "a"), (None, LONG_LINE, "en", "a"), (None, "é" * 40, "en", "a")]
    rows += [(108, LONG_LINE, "en", "a"), *HOSTILE]
    rows += [(i, "é" * 40 + "\r\n" + "😀" * 39, "en", "a") for i in range(400, 406)]
    df = documents(rows).repartition(5)
    assert result(line_dedup.drop_repeated_lines(df)) == brute(rows)
    assert result(line_dedup.drop_repeated_lines(df, min_docs=2, min_chars=4)) == brute(rows, 2, 4)
    assert result(line_dedup.drop_repeated_lines(hostile, min_docs=2, min_chars=0)) == brute(HOSTILE, 2, 0)


def test_repeated_rows_and_null_ids(documents):
    rows = [(None, LONG_LINE, "en", "a")] * 7 + [(1, "", "en", "a")]
    assert result(line_dedup.drop_repeated_lines(documents(rows))) == brute(rows)  # all are the last holder
    rows += [(2, LONG_LINE + "\n" + LONG_LINE, "en", "a")] * 3
    assert result(line_dedup.drop_repeated_lines(documents(rows))) == brute(rows)


def test_empty_and_other_ids(spark, nothing):
    assert line_dedup.drop_repeated_lines(nothing).collect() == []
    with pytest.raises(TypeError, match="whole numbers"):
        line_dedup.drop_repeated_lines(spark.createDataFrame([("a", "b")], "doc_id string, text string"))


def test_many_shards(documents, monkeypatch):
    monkeypatch.setattr(line_dedup, "SHARD_LINES", 3)
    rows = [(i, "\n".join(f"a line that is shared by some, number {(i * k) % 23}" for k in range(1, 8)), "en", "a") for i in range(80)]
    assert result(line_dedup.drop_repeated_lines(documents(rows))) == brute(rows)
