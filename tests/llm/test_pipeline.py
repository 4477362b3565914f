"""The pipeline stage by stage, and the registered queries against their SQL."""

from __future__ import annotations

import math
import os
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from churnlens.llm import mixing
from churnlens.llm import toxicity as tox
from churnlens.llm.common import shared_root
from churnlens.llm.queries import ORACLE_SQL, QUERIES
from tests.llm.test_jaccard_join import brute

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables not present")


def test_stages_in_order(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, rows = docs.columns, {r["doc_id"]: r for r in docs.collect()}
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["toxicity", "exact_dedup", "jaccard_join", "source_mixing", "sentencepiece"]

    def after(name, df):
        out = corpus_pipeline.shared_table(steps[name](spark, df, SF_DIR), "test-stage")
        return out, [r["doc_id"] for r in out.collect()]

    clean, ids = after("toxicity", docs)
    assert clean.columns == columns and 0.8 * len(rows) <= len(ids) <= len(rows)
    once, left = after("exact_dedup", clean)
    newest = {}
    for i in ids:
        newest[rows[i]["text"]] = max(i, newest.get(rows[i]["text"], -1))
    assert once.columns == columns and sorted(left) == sorted(newest.values())
    apart, kept = after("jaccard_join", once)
    want = brute([(i, rows[i]["text"]) for i in left], (8, 10), 5)
    assert apart.columns == columns and sorted(kept) == sorted({c for _, _, c in want})
    mixed, taken = after("source_mixing", apart)
    assert mixed.columns == columns and set(taken) <= set(kept) and max(Counter(taken).values()) <= 3
    final, done = after("sentencepiece", mixed)
    assert sorted(done) == sorted(taken)
    assert all(r["round_trip"] for r in final.collect())


def small_tables(spark, folder):
    """Documents with toxic texts, exact and near copies in uneven sources, and their labels."""
    rng = np.random.default_rng(11)
    plain = [f"{a}{b}" for a in ("walk", "tree", "rain", "stone", "light", "éclat") for b in ("er", "ing", "s", "ly", "o")]
    rude = ["zork", "zorkish", "blarg", "Blargs", "idiot", "you", "YOUR", "st0pid", "gr@mble", "zo*rk!!"]
    docs, labels = [], []
    for i in range(220):
        toxic = int(i % 5 < 2)
        words = [str(rng.choice(plain)) for _ in range(int(rng.integers(6, 45)))]
        for _ in range(int(rng.integers(1, 9)) if toxic else int(i % 11 == 0)):
            words[int(rng.integers(0, len(words)))] = str(rng.choice(rude))
        text = " ".join(words) + str(rng.choice(["", ".", "!!", "\n", "  end"]))
        if i % 10 == 7 and docs:
            text = docs[int(rng.integers(0, len(docs)))][1]
        elif i % 10 == 8 and docs:
            text = docs[int(rng.integers(0, len(docs)))][1] + " more"
        docs.append((i, text, "en", [None, "a", "a", "b", "a", "c", "a"][i % 7], len(text)))
        if i % 6:
            labels.append((i, 1, toxic))
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{folder}/documents.parquet"
    )
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return {d[0]: d for d in docs}


def plain_features(lexicon, text):
    def hits(low):
        found = [
            (k, term, not low[k + len(term) : k + len(term) + 1].isalnum())
            for term in {*lexicon, *tox.INSULTS, *tox.YOU}
            for k in range(len(low))
            if low.startswith(term, k) and not low[max(0, k - 1) : k].isalnum()
        ]
        terms = [(k, t) for k, t, _ in found if t in lexicon]
        return terms, sum(w and t in tox.INSULTS for _, t, w in found), [k for k, t, w in found if w and t in tox.YOU]

    low, data = text.lower(), text.encode()
    n, size = max(1, len(low.split())), max(1, len(data))
    terms, insults, you = hits(low)
    near = sum(any(abs(k - y) <= tox.NEAR for y in you) for k, _ in terms)
    letters = max(1, len(re.findall(rb"[A-Za-z\x80-\xff]", data)))
    symbols = rb"[0-9!#$%&*+@^|~]"
    inner = len(re.findall(rb"(?<=[A-Za-z\x80-\xff])" + symbols + rb"(?=[A-Za-z\x80-\xff])", data))
    masked = 0
    for word in tox.MASKED.findall(low) if inner else []:
        found = hits(re.sub(r"[*+._-]", "", word.translate(tox.PLAIN)))
        masked += bool(found[0] or found[1])
    return [
        len(terms) / n, math.log1p(len(terms)), sum(lexicon[t] for _, t in terms) / n, len({t for _, t in terms}),
        insults / n, near / n, len(you) / n, len(re.findall(rb"[A-Z]", data)) / letters,
        len(re.findall(rb"(?=[A-Z]{3})", data)) / size, len(re.findall(rb"[!?]", data)) / size,
        len(re.findall(rb"[!\"'(),\-.:;?]", data)) / size, len(re.findall(symbols, data)) / size,
        inner / n, masked / n, math.log1p(n),
    ]


def plain_score(model, text):
    at = Vectors.dense(plain_features(model.lexicon, text))
    margin = sum(w * t.predict(at) for w, t in zip(model.trees.treeWeights, model.trees.trees, strict=True))
    raw = 1 / (1 + math.exp(-2 * margin))
    return float(np.interp(raw, model.calibration.boundaries.toArray(), model.calibration.predictions.toArray()))


def plain_copies(rows, hashes):
    """Copies of each (id, text, source): streams, blocks and slots one after the other."""
    by_source = {}
    for i, text, source in rows:
        by_source.setdefault(source, []).append((hashes[i], i, len(re.findall(r"[^\x20\x09-\x0D]+", text)), zlib.crc32(text.encode())))
    sources = mixing.plan_sources([(s, len(x), sum(d[2] for d in x)) for s, x in by_source.items()])
    total = sum(s.slots for s in sources)
    ends = [sum(s.slots for s in sources[: k + 1]) * 2**64 // total for k in range(len(sources))]
    used, times, slot = [0] * len(sources), Counter(), 0
    while sum(used) < total:
        k = next(k for k, e in enumerate(ends) if slot * mixing.STEP % 2**64 < e)
        if used[k] < sources[k].slots:
            times[k, used[k] % sources[k].blocks] += 1
            used[k] += 1
        slot += 1
    out = Counter()
    for k, s in enumerate(sources):
        start, buckets = 0, 1 + s.rows // mixing.BUCKET_ROWS
        for _, i, size, _ in sorted(by_source[s.name], key=lambda d: (d[0] % buckets, d)):
            out[i] += times[k, min(start, max(0, s.words - 1)) // s.block_words]
            start += size
    return +out


def test_run_equals_plain_stages(spark, tmp_path, monkeypatch):
    from churnlens.llm import pieces
    from tests.llm.test_pieces import plain_viterbi

    rows = small_tables(spark, str(tmp_path))
    before = set(os.listdir(shared_root(spark)))
    written, write = {}, corpus_pipeline.shared_table
    monkeypatch.setattr(corpus_pipeline, "shared_table", lambda df, name: written.setdefault(name, write(df, name)))
    final = corpus_pipeline.run(spark, str(tmp_path))
    assert list(written) == [f"pipeline-{name}" for name, _ in corpus_pipeline.STAGES]
    # the stages' own tables stay, what they wrote on the way does not
    left = sorted(re.sub("-[0-9a-f]{32}$", "", n) for n in set(os.listdir(shared_root(spark))) - before)
    assert left == sorted(written)
    stage = [df.collect() for df in written.values()]
    assert all(tuple(r) == rows[r["doc_id"]] for out in stage[:4] for r in out)
    ids = [Counter(r["doc_id"] for r in out) for out in stage]

    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    model = tox.fit(docs, spark.read.parquet(f"{tmp_path}/labels.parquet"))
    scores = {i: plain_score(model, d[1]) for i, d in rows.items()}
    assert {r["doc_id"]: r["score"] for r in model.score(docs).collect()} == pytest.approx(scores, abs=1e-9)
    clean = [i for i in rows if scores[i] < tox.THRESHOLD]
    assert ids[0] == Counter(clean) and 100 < len(clean) < 200
    newest = {rows[i][1]: i for i in clean}
    assert ids[1] == Counter(newest.values()) and len(newest) < len(clean)
    kept = {c for _, _, c in brute([(i, rows[i][1]) for i in newest.values()], (8, 10), 5)}
    assert ids[2] == Counter(kept) and len(kept) < len(newest)
    hashes = dict(docs.select("doc_id", F.xxhash64(F.lit("doc_id"), "doc_id")).collect())
    copies = plain_copies([(i, rows[i][1], rows[i][3]) for i in kept], hashes)
    assert ids[3] == copies and set(copies.values()) != {1}
    piece, known = pieces.PieceModel(pieces.default_model()), {}
    want = Counter()
    for i, times in copies.items():
        for word in piece.split(rows[i][1]):
            if word not in known:
                known[word] = plain_viterbi(piece, word).tolist()
        found = [x for word in piece.split(rows[i][1]) for x in known[word]]
        want[i, len(found), tuple(found), True] += times
    assert Counter((r["doc_id"], r["n_ids"], tuple(r["ids"]), r["round_trip"]) for r in final.collect()) == want


def test_registered():
    names = entry.queries()
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)}
    assert set(QUERIES) <= set(names) and "pipeline" in names
    assert set(ORACLE_SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({ORACLE_SQL[name]})").fetchall()
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in df.select(*columns).collect())
