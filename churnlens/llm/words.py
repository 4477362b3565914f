"""Encoding texts word by word: a worker encodes a distinct word once and remembers it."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa

#: Characters worked on at once, distinct words that a coder remembers, and words encoded at once.
CALL_CHARS = 1 << 20
KEPT_WORDS = 500_000
NEW_WORDS = 8192

#: Where a worker process keeps what its tasks share: task functions travel by value, so their own globals do not last.
PROCESS = "churnlens_worker_process"


def per_process(key: str, make: Callable[[], object]):
    """``make()``, once per worker process, for all its tasks with this key; another key's object is dropped."""
    kept = sys.modules.setdefault(PROCESS, types.ModuleType(PROCESS))
    if getattr(kept, "key", None) != key:
        kept.key, kept.value = None, None
        kept.value = make()
        kept.key = key
    return kept.value


def forget() -> None:
    """Drop what tasks of other operators left in this worker process."""
    kept = sys.modules.get(PROCESS)
    if kept is not None:
        kept.key, kept.value = None, None


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of each (start, length) range, one after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(int(ends[-1]) if len(ends) else 0)


def by_distinct(words: pa.Array, encode: Callable[[pa.Array], pa.Array]) -> pa.Array:
    """The packed ids of all words; Arrow finds the distinct ones, which alone are encoded, and puts their ids in place."""
    coded = words.dictionary_encode()
    return encode(coded.dictionary).take(coded.indices)


def joined(packed: pa.Array, counts: np.ndarray) -> pa.Array:
    """Runs of so many packed values, each joined to one."""
    if not len(packed):
        return pa.array([b""] * len(counts), pa.large_binary())
    ends = np.frombuffer(packed.buffers()[1], dtype=np.int64)[packed.offset : packed.offset + len(packed) + 1]
    ends = ends[np.concatenate([[0], np.cumsum(counts)])]
    data = packed.buffers()[2] or pa.py_buffer(b"")
    return pa.Array.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(ends), data])


def cut(texts: list[str], split: Callable[[str], list[str]]) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, and how many each has."""
    words = [split(t) for t in texts]
    return pa.array(list(chain.from_iterable(words)), pa.large_string()), np.array([len(w) for w in words], dtype=np.int64)


class WordCoder:
    """Packed ids of texts, joined from the packed ids of their words.

    ``split`` cuts a text into words; ``encode`` gives the packed ids of a
    list of distinct words. Words are remembered in two generations of half
    of KEPT_WORDS each: a word that was not met during the younger one is
    forgotten, so frequent words stay.
    """

    def __init__(self, split: Callable[[str], list[str]], encode: Callable[[list[str]], list[bytes]]):
        self.split, self.encode = split, encode
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def __call__(self, texts: list[str]) -> list[bytes]:
        words, counts = cut(texts, self.split)
        return joined(by_distinct(words, self.packed), counts).to_numpy(zero_copy_only=False).tolist()

    def packed(self, distinct: pa.Array) -> pa.Array:
        """The packed ids of distinct words."""
        words = distinct.to_numpy(zero_copy_only=False).tolist()
        missing = [w for w in words if w not in self.known]
        if len(self.known) + len(missing) > KEPT_WORDS // 2 and self.known:
            self.older, self.known = self.known, {}
            missing = words
        self._learn(missing)
        return pa.array(list(map(self.known.__getitem__, words)), pa.large_binary())

    def _learn(self, missing: list[str]) -> None:
        new = []
        for word in missing:
            ids = self.older.get(word)
            if ids is None:
                new.append(word)
            else:
                self.known[word] = ids
        for at in range(0, len(new), NEW_WORDS):
            some = new[at : at + NEW_WORDS]
            self.known.update(zip(some, self.encode(some), strict=True))


def calls(texts: list[str], chars: int = CALL_CHARS) -> Iterator[list[str]]:
    """Runs of texts of about ``chars`` characters; a longer text is a run of its own."""
    call, size = [], 0
    for text in texts:
        call.append(text)
        size += len(text)
        if size >= chars:
            yield call
            call, size = [], 0
    if call:
        yield call
