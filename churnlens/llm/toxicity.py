"""Toxicity: gradient-boosted trees over dense features, calibrated.

A lexicon of word beginnings is learned from a bounded sample of labelled
texts (how much more often they start words of toxic texts), next to a short
fixed list. Each text becomes a few dense numbers: lexicon densities, how many
of the hits stand near a second person, rates of capitals, punctuation and
words with symbols inside them, and of hits once those symbols are read as
letters. Boosted trees score them, and isotonic regression on labelled rows
the trees did not see turns the score into a probability.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens.llm.common import SMALL_BATCH_BYTES, bound_batches, shared_table
from churnlens.llm.words import calls, forget

#: Labelled rows that models are fitted on, at most (those of smallest id hash).
TRAIN_ROWS = 30_000
#: Files of the labelled rows (a bounded table).
TRAIN_FILES = 12
#: One row in so many of them calibrates; the others teach the lexicon and the trees.
CALIBRATION = 4
#: Word beginnings the lexicon may hold, their lengths, and what a term must show.
TERMS = 400
LENGTHS = (4, 5, 6)
LEAST_TEXTS, LEAST_SHARE, LEAST_LOG_ODDS = 4, 0.01, 2.5
#: Uses of a beginning that one text can add.
MOST_USES = 5
TREES, DEPTH, STEP = 20, 4, 0.3
THRESHOLD = 0.7
#: Characters between a hit and a second person that count as near.
NEAR = 40

# Common insults, and second-person words of a few languages.
INSULTS = "idiot moron stupid loser scum trash clown worthless pathetic disgusting dumb hate kill ugly".split()
YOU = (
    "you your yours yourself u ur du dich dir dein deine ihr euch euer tu te toi ton ta vous votre vos "
    "tú ti usted ustedes vosotros tus su"
).split()
#: Symbols and the letters they stand for.
PLAIN = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l"})
MASKED = re.compile(r"[^\W\d_]+(?:[0-9@$!|*+._-]+[^\W\d_]+)+")

FEATURES = (
    "lexicon_rate", "lexicon_hits", "lexicon_weight", "lexicon_terms", "insult_rate", "near_you_rate", "you_rate",
    "capital_rate", "capital_runs", "exclaim_rate", "punctuation_rate", "symbol_rate", "masked_rate",
    "masked_hit_rate", "words",
)

_UPPER, _LETTER, _EXCLAIM, _PUNCT, _SYMBOL = range(5)
_CLASS = np.zeros((5, 256), dtype=np.uint8)
_CLASS[_UPPER, 65:91] = 1
_CLASS[_LETTER, 65:91] = _CLASS[_LETTER, 97:123] = _CLASS[_LETTER, 128:] = 1
_CLASS[_EXCLAIM, [33, 63]] = 1
_CLASS[_PUNCT, [33, 34, 39, 40, 41, 44, 45, 46, 58, 59, 63]] = 1
_CLASS[_SYMBOL, [*range(48, 58), 33, 35, 36, 37, 38, 42, 43, 64, 94, 124, 126]] = 1


def beginnings(text: str) -> Counter[str]:
    """Beginnings of the words of a text and how many words have each."""
    out: Counter[str] = Counter()
    for word, times in Counter(re.findall(r"[^\W\d_]+", text.lower())).items():
        for n in LENGTHS:
            if len(word) >= n:
                out[word[:n]] += times
    return out


def learn_lexicon(train: DataFrame) -> dict[str, float]:
    """Word beginnings with their log odds, from (text, toxic) rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forget()
        texts, uses = Counter(), (Counter(), Counter())
        for batch in batches:
            for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
                for term, times in beginnings(text).items():
                    uses[toxic][term] += min(times, MOST_USES)
                    texts[term] += toxic
        terms = pd.Series(sorted(uses[0].keys() | uses[1].keys()), dtype=object)
        counts = {"texts": texts, "pos": uses[1], "neg": uses[0]}
        yield pd.DataFrame({"term": terms} | {k: [x[t] for t in terms] for k, x in counts.items()})

    n = {r["toxic"]: r["count"] for r in train.groupBy("toxic").count().collect()}
    pos, neg = n.get(1, 0), n.get(0, 0)
    if not pos or not neg:
        return {}
    odds = F.log((F.col("pos") + 0.5) / (pos + 1)) - F.log((F.col("neg") + 0.5) / (neg + 1))
    counted = train.mapInPandas(run, "term string, texts long, pos long, neg long").groupBy("term")
    found = (
        counted.agg(*[F.sum(c).alias(c) for c in ("texts", "pos", "neg")])
        .filter(F.col("texts") >= max(LEAST_TEXTS, math.ceil(LEAST_SHARE * pos)))
        .select("term", "texts", odds.alias("odds"))
        .filter(F.col("odds") >= LEAST_LOG_ODDS)
        .orderBy(F.desc(F.col("odds") * F.log1p("texts")), "term")
        .limit(TERMS)
        .collect()
    )
    terms = {r["term"]: r["odds"] for r in found}
    return {t: w for t, w in terms.items() if not any(t[:n] in terms for n in LENGTHS if n < len(t))}


class Featurizer:
    """Dense features of texts, for one lexicon."""

    def __init__(self, lexicon: dict[str, float]):
        import ahocorasick

        self.lexicon = lexicon
        terms: dict[str, list] = {t: [t, w, False, False] for t, w in lexicon.items()}
        for word in INSULTS:
            terms.setdefault(word, [word, 0.0, False, False])[2] = True
        for word in YOU:
            terms.setdefault(word, [word, 0.0, False, False])[3] = True
        self.find = ahocorasick.Automaton()
        for term, value in terms.items():
            self.find.add_word(term, tuple(value))
        self.find.make_automaton()

    def hits(self, text: str) -> tuple[list[int], dict[str, float], list[float], int, list[int]]:
        """Places and weights of lexicon hits, insults, and places of second persons."""
        at, terms, weights, insults, you = [], {}, [], 0, []
        last = len(text) - 1
        for end, (term, weight, insult, person) in self.find.iter(text):
            start = end - len(term) + 1
            if start and text[start - 1].isalnum():
                continue
            whole = end == last or not text[end + 1].isalnum()
            if weight:
                at.append(start)
                weights.append(weight)
                terms[term] = weight
            insults += insult and whole
            if person and whole:
                you.append(start)
        return at, terms, weights, insults, you

    def __call__(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), len(FEATURES)))
        parts = [t.encode("utf-8", "surrogatepass") for t in texts]
        data = np.frombuffer(b"\n".join(parts) + b"\n", dtype=np.uint8)
        ends = np.cumsum([len(p) + 1 for p in parts])
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        kinds = [k[data] for k in _CLASS]
        inner = np.zeros(len(data), dtype=np.uint8)
        inner[1:-1] = kinds[_SYMBOL][1:-1] & kinds[_LETTER][:-2] & kinds[_LETTER][2:]
        runs = np.zeros(len(data), dtype=np.uint8)
        runs[2:] = kinds[_UPPER][2:] & kinds[_UPPER][1:-1] & kinds[_UPPER][:-2]
        sums = [np.add.reduceat(x.astype(np.int64), starts) for x in (*kinds, inner, runs)]
        size = np.maximum(ends - starts - 1, 1)
        out[:, 7] = sums[_UPPER] / np.maximum(sums[_LETTER], 1)
        out[:, 8] = sums[6] / size
        out[:, 9] = sums[_EXCLAIM] / size
        out[:, 10] = sums[_PUNCT] / size
        out[:, 11] = sums[_SYMBOL] / size
        for i, text in enumerate(texts):
            low = text.lower()
            words = max(1, len(low.split()))
            at, terms, weights, insults, you = self.hits(low)
            near = 0
            if at and you:
                k = np.searchsorted(you, at)
                left = np.abs(np.array(at) - np.array(you)[np.maximum(k - 1, 0)])
                right = np.abs(np.array(at) - np.array(you)[np.minimum(k, len(you) - 1)])
                near = int((np.minimum(left, right) <= NEAR).sum())
            masked = 0
            if sums[5][i]:
                for word in MASKED.findall(low):
                    plain = self.hits(re.sub(r"[*+._-]", "", word.translate(PLAIN)))
                    masked += bool(plain[0] or plain[3])
            out[i, :7] = (
                len(at) / words, math.log1p(len(at)), sum(weights) / words, len(terms), insults / words, near / words,
                len(you) / words,
            )
            out[i, 12:] = sums[5][i] / words, masked / words, math.log1p(words)
        return out


def features_udf(lexicon: dict[str, float]):
    @F.pandas_udf("array<double>")
    def features(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        forget()
        of = Featurizer(lexicon)
        for batch in batches:
            rows = [row for call in calls(batch.tolist()) for row in of(call)]
            yield pd.Series(rows, dtype=object)

    return features


@dataclass(frozen=True)
class ToxicityModel:
    """Lexicon, trees and calibration; with too few labels a constant share."""

    lexicon: dict[str, float]
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    share: float

    def score(self, docs: DataFrame, text_col: str = "text", name: str = "score") -> DataFrame:
        """``docs`` with a score in [0, 1]; a null text counts as empty."""
        bound_batches(docs.sparkSession, SMALL_BATCH_BYTES)
        if self.trees is None:
            return docs.withColumn(name, F.lit(self.share))
        text = F.coalesce(F.col(text_col), F.lit(""))
        kept = [c for c in docs.columns if c != name]  # a column of that name is replaced
        rows = docs.withColumn("__features", array_to_vector(features_udf(self.lexicon)(text)))
        scored = self.trees.transform(rows).withColumn("__raw", vector_to_array("__probability")[1])
        if self.calibration is None:
            return scored.select(*kept, F.col("__raw").alias(name))
        return self.calibration.transform(scored).select(*kept, F.col("__calibrated").alias(name))


def held_out(id_col: Column) -> Column:
    """Rows never learned from: crc32 of the id as text, mod 3, is 1."""
    return F.coalesce(F.crc32(F.encode(id_col.cast("string"), "UTF-8")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> ToxicityModel:
    """Fit on labelled rows (``toxic`` 0 or 1) outside the held-out third.

    At most TRAIN_ROWS labelled rows are used, those whose id hashes smallest;
    equal texts count once. Null ids and labels are not used; of repeated
    labels the larger counts.
    """
    bound_batches(docs.sparkSession, SMALL_BATCH_BYTES)
    usable = labels.filter(F.col(id_col).isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col(id_col)))
    chosen = (
        usable.groupBy(id_col)
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64(id_col), id_col)
        .limit(TRAIN_ROWS)
    )
    texts = docs.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # at most TRAIN_ROWS rows of two numbers are broadcast
    joined = texts.join(F.broadcast(chosen), id_col).withColumn("digest", F.xxhash64("text"))
    train = shared_table(
        joined.groupBy("digest").agg(F.min_by(F.struct("text", "toxic"), id_col).alias("x")).select(
            "digest", "x.*", (F.pmod(F.hash("digest"), F.lit(CALIBRATION)) == 0).alias("calibrates")
        ).coalesce(TRAIN_FILES),
        "toxicity-train",
    )
    counts = {(r["calibrates"], r["toxic"]): r["count"] for r in train.groupBy("calibrates", "toxic").count().collect()}
    total = sum(counts.values())
    share = (counts.get((True, 1), 0) + counts.get((False, 1), 0)) / total if total else 0.0
    if not (counts.get((False, 0)) and counts.get((False, 1))):
        return ToxicityModel({}, None, None, share)
    lexicon = learn_lexicon(train.filter("not calibrates").select("text", "toxic"))
    rows = shared_table(
        train.select(
            "digest", "calibrates", F.col("toxic").cast("double").alias("label"), features_udf(lexicon)("text").alias("f")
        ),
        "toxicity-features",
    )
    # a bounded sample: one sorted partition costs little and makes reruns agree
    rows = rows.coalesce(1).sortWithinPartitions("digest")
    vectors = rows.select("calibrates", "label", array_to_vector("f").alias("__features"))
    trees = GBTClassifier(
        featuresCol="__features", labelCol="label", predictionCol="__prediction", maxIter=TREES, maxDepth=DEPTH,
        stepSize=STEP, seed=1,
    )
    trees = trees.setRawPredictionCol("__margin").setProbabilityCol("__probability").fit(
        vectors.filter("not calibrates")
    )
    if not (counts.get((True, 0)) and counts.get((True, 1))):
        return ToxicityModel(lexicon, trees, None, share)
    raw = trees.transform(vectors.filter("calibrates")).select(
        "label", vector_to_array("__probability")[1].alias("__raw")
    )
    isotonic = IsotonicRegression(featuresCol="__raw", labelCol="label", predictionCol="__calibrated")
    return ToxicityModel(lexicon, trees, isotonic.fit(raw), share)


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below ``threshold``."""
    scored = fit(docs, labels).score(docs, name="__score")
    return scored.filter(F.col("__score") < threshold).select(*docs.columns)
