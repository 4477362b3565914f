"""SentencePiece encoding and decoding by batched Viterbi.

A text is escaped as the model does (a dummy prefix, spaces as U+2581) and cut
where a run of escaped spaces begins; no piece of the model reaches over such
a place, so the best segmentation of a text is that of its words. Distinct
words of equal length advance together: rolling hashes of all their substrings
probe the sorted piece keys, and at each position the vectorised maximum over
piece lengths stores a backpointer. The score of a segmentation is the sum of
the model's piece scores; ties go to the longest last piece. A character that
no piece covers is spelled in byte pieces. A long word advances in windows, so
it takes a few bytes a character.

This is the unigram way to segment. A model that was trained as BPE gives other
ids by its own merges (about 14 % fewer on the check tables): its pieces and
scores are used here, its merge order is not. Decoding is exact either way.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.llm.common import SMALL_BATCH_BYTES, bound_batches
from churnlens.llm.words import WordCoder, calls, per_process, spread

SPACE = "▁"
WORDS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
#: Base of the rolling hash (odd), and cells of one batch of words.
BASE = np.uint64(0x9E3779B97F4A7C15)
CELLS = 1 << 16
#: Places of a word that are scored at once.
WINDOW = 1 << 12
#: Top bits of a key that the filter before the search sees.
KEY_SHIFT = np.uint64(44)
#: An uncovered character scores this below the worst piece.
UNKNOWN = 10.0


class PieceModel:
    """Pieces of a SentencePiece model as sorted hash keys."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.text = [model.id_to_piece(i) for i in range(size)]
        plain = [
            i
            for i in range(size)
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        ]
        if any(SPACE in self.text[i].lstrip(SPACE) for i in plain):
            raise ValueError("a piece holds a space after other characters; words cannot be cut at spaces")
        self.unknown = model.unk_id()
        self.bytes = np.full(256, self.unknown, dtype=np.int64)
        for i in range(size):
            if model.is_byte(i):
                self.bytes[int(self.text[i][3:5], 16)] = i
        spelled = [b"" if model.is_control(i) else t.replace(SPACE, " ").encode() for i, t in enumerate(self.text)]
        for b, i in enumerate(self.bytes):
            if i != self.unknown:
                spelled[i] = bytes([b])
        self.spelling = np.frombuffer(b"".join(spelled), dtype=np.uint8)
        self.sizes = np.array([len(x) for x in spelled], dtype=np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        keys = self.word_keys([self.text[i] for i in plain])
        # most substrings are no piece: the top bits of their keys say so before the search
        self.filter = np.zeros(1 << (64 - int(KEY_SHIFT)), dtype=bool)
        self.filter[keys >> KEY_SHIFT] = True
        keys = keys * BASE  # keys of one character differ in their low bits only
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.array(plain, dtype=np.int64)[order]
        self.scores = np.array([model.get_score(int(i)) for i in self.ids], dtype=float)
        self.longest = max((len(self.text[i]) for i in plain), default=1)
        if self.longest > 255:
            raise ValueError("a piece has over 255 characters")
        self.powers = np.array([pow(int(BASE), k, 1 << 64) for k in range(self.longest + 1)], dtype=np.uint64)
        # where the keys with these top bits begin, and how many at most share them
        tops = np.arange(len(self.filter), dtype=np.uint64) << KEY_SHIFT
        self.first = np.searchsorted(self.keys, tops).astype(np.int32)
        self.most = int(np.bincount((self.keys >> KEY_SHIFT).astype(np.int64), minlength=1).max())
        self.penalty = float(self.scores.min(initial=0.0)) - UNKNOWN

    @staticmethod
    def key(chars: np.ndarray) -> np.ndarray:
        """Rolling hashes of the prefixes of each row, the empty one first."""
        out = np.zeros((*chars.shape[:-1], chars.shape[-1] + 1), dtype=np.uint64)
        for j in range(chars.shape[-1]):
            out[..., j + 1] = out[..., j] * BASE + chars[..., j] + np.uint64(1)
        return out

    @classmethod
    def word_keys(cls, words: list[str]) -> np.ndarray:
        """Hash of each whole word; words of one length are hashed together."""
        keys, lengths = np.zeros(len(words), dtype=np.uint64), np.array([len(w) for w in words], dtype=np.int64)
        for n in np.unique(lengths):
            same = np.flatnonzero(lengths == n)
            chars = codes("".join(words[i] for i in same)).reshape(len(same), int(n))
            keys[same] = cls.key(chars)[:, -1]
        return keys

    def lattice(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backpointers of words of one length (rows of code points): piece
        length and id (-1: unknown character) of the best path to each place."""
        m, n = chars.shape
        widest = min(self.longest, n)
        step, piece = np.ones((m, n + 1), dtype=np.uint8), np.full((m, n + 1), -1, dtype=np.int32)
        best, rows = np.zeros((m, 1)), np.arange(m)
        # a long word advances window by window: only the last scores are carried over
        for a in range(0, n, WINDOW):
            b = min(n, a + WINDOW)
            low = max(0, a + 1 - widest)  # the first place where a piece that ends in the window can begin
            score, ids = self.window(chars[:, low:b], a - low, widest)
            known = best.shape[1]
            best = np.concatenate([best, np.zeros((m, b - a))], axis=1)
            for j in range(a + 1, b + 1):
                reach, at = min(widest, j), known + j - a - 1
                paths = best[:, at - reach : at] + score[j - a - 1, :, widest - reach :]
                top = paths.argmax(axis=1)
                best[:, at] = paths[rows, top]
                step[:, j] = reach - top
                piece[:, j] = ids[j - a - 1, rows, widest - reach + top]
            best = best[:, -widest:]
        return step, piece

    def place(self, keys: np.ndarray) -> np.ndarray:
        """Where each key is among the sorted ones, if it is one of them."""
        at = np.minimum(self.first[keys >> KEY_SHIFT], len(self.keys) - 1)
        for _ in range(self.most - 1):
            at = np.minimum(at + (self.keys[at] < keys), len(self.keys) - 1)
        return at

    def window(self, chars: np.ndarray, skip: int, widest: int) -> tuple[np.ndarray, np.ndarray]:
        """Scores and ids of the pieces that end after the first ``skip`` characters, by
        end place and length, the longest first: the first maximum is the longest piece."""
        m, n = chars.shape
        prefix = self.key(chars)
        score = np.full((n - skip, m, widest), -np.inf)
        ids = np.full((n - skip, m, widest), -1, dtype=np.int32)
        score[:, :, -1] = self.penalty
        for size in range(1, min(widest, n) + 1):
            found = prefix[:, size:] - prefix[:, :-size] * self.powers[size]
            row, start = np.nonzero(self.filter[found >> KEY_SHIFT])
            keys = found[row, start] * BASE
            at = self.place(keys)
            end = start + size - skip - 1
            hit = (self.keys[at] == keys) & (end >= 0)
            at, row, end = at[hit], row[hit], end[hit]
            score[end, row, widest - size] = self.scores[at]
            ids[end, row, widest - size] = self.ids[at]
        return score, ids

    def encode_words(self, words: list[str]) -> list[np.ndarray]:
        """Ids of each word; words are grouped by length and done in bounded batches."""
        out: list[np.ndarray] = [np.zeros(0, "<i4")] * len(words)
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        order = np.argsort(lengths, kind="stable")
        for n in np.unique(lengths):
            same = order[np.searchsorted(lengths[order], n) : np.searchsorted(lengths[order], n, side="right")]
            many = max(1, CELLS // max(1, int(n)))
            for at in range(0, len(same) if n else 0, many):
                some = same[at : at + many]
                chars = codes("".join(words[i] for i in some)).reshape(len(some), int(n))
                for row, ids in zip(some, self.paths(chars), strict=True):
                    out[row] = ids
        return out

    def paths(self, chars: np.ndarray) -> list[np.ndarray]:
        """Follow the backpointers of all rows at once."""
        step, piece = self.lattice(chars)
        m, n = chars.shape
        if n > WINDOW:
            return [self.long_path(c, s, p) for c, s, p in zip(chars, step, piece, strict=True)]
        row, end = np.arange(m), np.full(m, n, dtype=np.int64)
        ends_here, ids = np.zeros((m, n + 1), dtype=bool), np.zeros((m, n + 1), dtype="<i4")
        while len(row):
            own = piece[row, end]
            start = end - step[row, end]
            ends_here[row, end] = True
            ids[row, end] = np.where(own >= 0, own, -1 - chars[row, start].astype(np.int64))
            row, end = row[start > 0], start[start > 0]
        ids = ids[ends_here]  # row by row, each in order of place
        cuts = np.concatenate([[0], np.cumsum(ends_here.sum(axis=1))])
        found = [ids[a:b] for a, b in zip(cuts.tolist(), cuts[1:].tolist(), strict=False)]
        for i in np.unique(np.searchsorted(cuts, np.flatnonzero(ids < 0), side="right") - 1).tolist():
            found[i] = self.spelled(found[i])
        return found

    def long_path(self, chars: np.ndarray, step: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """Follow the backpointers of one long word."""
        out, end = array("q"), len(chars)
        while end:
            start = end - int(step[end])
            out.append(int(piece[end]) if piece[end] >= 0 else -1 - int(chars[start]))
            end = start
        ids = np.frombuffer(out, dtype=np.int64)[::-1].astype("<i4")
        return self.spelled(ids) if (ids < 0).any() else ids

    def spelled(self, ids: np.ndarray) -> np.ndarray:
        """Uncovered characters (stored as -1 - code point) as byte pieces."""
        parts = [
            [i] if i >= 0 else self.bytes[list(chr(-1 - i).encode("utf-8", "surrogatepass"))].tolist()
            for i in ids.tolist()
        ]
        return np.array([i for part in parts for i in part], dtype="<i4")

    def split(self, text: str) -> list[str]:
        return WORDS.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def decode(self, ids) -> str:
        """The text of some ids: byte pieces joined, spaces restored, the dummy prefix gone."""
        ids = np.asarray(ids, dtype=np.int64)
        text = self.spelling[spread(self.begins[ids], self.sizes[ids])].tobytes().decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)


def encode_texts(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>, round_trip) of every whole text.

    ``round_trip`` tells whether the ids decode to the text (one that itself
    holds U+2581 decodes with spaces there). Null and empty texts have no ids;
    repeated rows repeat. ``model`` is the path of a SentencePiece model.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def make() -> tuple[PieceModel, WordCoder]:
            pieces = PieceModel(model)
            return pieces, WordCoder(pieces.split, lambda words: [x.tobytes() for x in pieces.encode_words(words)])

        pieces, coder = per_process(f"pieces:{model}", make)
        for batch in batches:
            at = 0
            for call in calls(batch["__t"].tolist()):
                found = [np.frombuffer(x, dtype="<i4") for x in coder(call)]
                ids = batch[id_col].iloc[at : at + len(call)]
                at += len(call)
                back = [pieces.decode(x) == t for x, t in zip(found, call, strict=True)]
                yield pd.DataFrame({id_col: ids, "ids": found, "round_trip": back})

    bound_batches(docs.sparkSession, SMALL_BATCH_BYTES)
    text = F.coalesce(F.col(text_col), F.lit(""))
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(id_col, text.alias("__t"))
    return rows.mapInPandas(run, f"`{id_col}` {kind}, ids array<int>, round_trip boolean")


def decode_ids(encoded: DataFrame, model: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``, the text its ids spell; null ids give null."""

    @F.pandas_udf("string")
    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        pieces = PieceModel(model)
        for batch in batches:
            yield pd.Series([None if x is None else pieces.decode(x) for x in batch], dtype=object)

    return encoded.withColumn("decoded", decoded(F.col(ids_col)))


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def encoded_digests(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_ids, ids, round_trip) of ``encode_texts``."""
    encoded = encode_texts(docs, model, id_col, text_col)
    return encoded.select(id_col, F.size("ids").cast("long").alias("n_ids"), "ids", "round_trip")
