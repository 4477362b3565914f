"""Length-limited code, block decoding, token files against the plain tokenizer."""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from churnlens.llm import huffman


def plain_huffman_cost(counts):
    heap, cost = list(counts), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        cost += both
        heapq.heappush(heap, both)
    return cost


@settings(max_examples=40, deadline=None, derandomize=True)
@given(st.lists(st.integers(1, 10_000), min_size=2, max_size=60))
def test_lengths_are_optimal_and_limited(counts):
    counts = np.array(counts)
    free = huffman.code_lengths(counts, 40)
    assert int((free * counts).sum()) == plain_huffman_cost(counts.tolist())
    short = huffman.code_lengths(counts, 6)
    assert short.max() <= 6 and sum(2.0 ** -int(x) for x in short) <= 1


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 5000])
def test_round_trip(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.geometric(0.02, n) * 7, 60_000).astype(np.int64)
    symbols, counts = np.unique(np.append(ids, [1, 2, 3]), return_counts=True)
    code = huffman.Code.of_counts(symbols, counts, 12)
    payload, marks = code.encode(ids)
    assert len(marks) == -(-n // huffman.STRIDE)
    assert (huffman.Decoder(code).decode(payload, marks, n) == ids).all()


@pytest.mark.parametrize("limit", [3, 12, 16, 17, 30, 40])
def test_codes_are_packed_first_bit_first(limit):
    rng = np.random.default_rng(limit)
    symbols = np.arange(8) * 9
    lengths = np.minimum(np.arange(1, 9), limit) if limit > 3 else np.full(8, 3)
    lengths[-2:] = limit
    code = huffman.Code(symbols, lengths)
    for n in [1, 2, 3, 5, 63, 64, 257, 1000]:
        at = rng.integers(0, 8, n)
        bits = [format(code.codes[i], f"0{code.lengths[i]}b") for i in at]
        payload, marks = code.encode(symbols[at].astype("<u2"))
        plain = "".join(bits)
        assert payload == int(plain.ljust(-(-len(plain) // 8) * 8, "0"), 2).to_bytes(-(-len(plain) // 8))
        assert marks.tolist() == [len("".join(bits[:i])) for i in range(0, n, huffman.STRIDE)]


def test_batches_are_gathered_so_that_words_repeat():
    import pyarrow as pa

    texts = ["aa", "b" * 9, "", "é", "c" * 25, "d", "e" * 3, "f" * 4]
    rows = pa.table({"id": range(len(texts)), "t": texts})
    for rows_each in (1, 3, 8):
        calls = list(huffman.calls_of(iter(rows.to_batches(max_chunksize=rows_each)), "t", 10))
        assert [c["id"].to_pylist() for c in calls] == [[0, 1], [2, 3, 4], [5, 6, 7]], rows_each
        assert [x for c in calls for x in c["t"].to_pylist()] == texts
    assert list(huffman.calls_of(iter([]), "t", 10)) == []


def test_token_files_without_words_of_letters(spark, documents):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path, target = public.path("word_bpe_49k.json"), huffman.new_path(spark)
    rows = [(1, "12 5, ...\x0b7\x0c.", "en", "a"), (2, "\u2028 \xa0\x85 9", "en", "a"), (3, " \t", "en", "a")]
    huffman.write_token_files(documents(rows).coalesce(1), target, path, end_id=2)
    tok = Tokenizer.from_file(path)
    found = huffman.read_token_files(spark, target).orderBy("id").collect()
    want = [[*tok.encode(r[1], add_special_tokens=False).ids, 2] for r in rows]
    assert [np.frombuffer(r["ids"], dtype="<u4").tolist() for r in found] == want


def test_token_files(spark, documents, nothing, monkeypatch):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    from tests.llm.conftest import HOSTILE

    monkeypatch.setattr(huffman, "BLOCK_TOKENS", 64)
    path = public.path("word_bpe_49k.json")
    odd = [
        "Don't, can't.We'll 3.5,x .a. ..., İstanbul É. é́.x",
        "a<|endoftext|>b <|startoftext|>, x.<|endoftext|>",
        "Ⅷ.² x².y ß, ﬁ. ́a.́ \x1c.\x85b,\xa0c  d.",
        "it's.he's,'s.x '.s a'.s #.# 5,5 x_.y",
        "IT'S <|ENDOFTEXT|> K\u212a ΑΣ Σ. \u2028x\u3000y\x1fz\x1d",
    ]
    rows = HOSTILE + [(100 + i, t, "en", "a") for i, t in enumerate(odd)]
    target = huffman.new_path(spark)
    huffman.write_token_files(documents(rows).repartition(3), target, path, end_id=2)
    found = huffman.token_digests(huffman.read_token_files(spark, target)).collect()
    tok = Tokenizer.from_file(path)
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    ids = [np.array([*tok.encode(r[1] or "", add_special_tokens=False).ids, 2], dtype="<u4") for r in rows]
    start, want = 0, []
    for r, x in zip(rows, ids, strict=True):
        want.append((r[0], len(x), zlib.crc32(x.tobytes())))
    got = sorted(found, key=lambda r: r["start"])
    assert sorted(map(repr, want)) == sorted(repr((r["doc_id"], r["n_tokens"], r["ids_crc32"])) for r in got)
    for r in got:
        assert r["start"] == start
        start += r["n_tokens"]
    known = [r["doc_id"] for r in got if r["doc_id"] is not None]
    assert known == sorted(known)
    target = huffman.new_path(spark)
    huffman.write_token_files(nothing, target, path, end_id=2)
    assert huffman.read_token_files(spark, target).count() == 0


def test_words_are_cut_where_the_tokenizer_cuts():
    public = pytest.importorskip("public_tokenizers")
    import pyarrow as pa
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public.path("word_bpe_49k.json"))
    rng = np.random.default_rng(3)
    signs = ["a", "B", "é", "É", "İ", "ı", "ß", "ẞ", "'", "'s", "'ll", ".", "...", "5", "²", "ª", "́", "_", "—", "Σ", "Ÿ", "Ɓ", "|", "<"]
    words = ["".join(rng.choice(signs, n)) for n in rng.integers(1, 9, 4000)] + ["a<|endoftext|>.b", "X<|ENDOFTEXT|>."]
    parts, counts = huffman.parts_of(pa.array(words, pa.large_string()))
    parts, at = parts.to_pylist(), np.cumsum([0, *counts]).tolist()
    for word, a, b in zip(words, at, at[1:], strict=False):
        ids = [i for part in parts[a:b] for i in tok.encode(part, add_special_tokens=False).ids]
        assert ids == tok.encode(word, add_special_tokens=False).ids, word
    # so words that differ in case and in signs after them share what is encoded
    parts, _ = huffman.parts_of(pa.array(["Überall", "überall,", "ÜBERALL..."], pa.large_string()))
    assert parts.to_pylist() == ["überall", "überall", ",", "überall", "..."]
