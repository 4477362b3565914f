"""Word shingles of texts as sorted arrays of 64-bit hashes."""

from __future__ import annotations

import hashlib

import numpy as np

# The finalizer of a 64-bit mixer, and odd multipliers per word of a shingle.
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = 0x100000001B3
_PLACE = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)

_BYTE = np.arange(256, dtype=np.uint64) + np.uint64(1)
_BYTE[65:91] += np.uint64(32)  # A-Z count as a-z
_GAP = np.zeros(256, dtype=bool)
_GAP[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    out = np.empty(n, dtype=np.uint64)
    if n:
        out[0] = 1
        out[1:] = _BASE
        np.multiply.accumulate(out, out=out)
    return out


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and where each text's words begin."""
    parts = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\n".join(parts) + b"\n", dtype=np.uint8)
    gap = _GAP[data]
    starts = np.flatnonzero(~gap & np.concatenate([[True], gap[:-1]]))
    ends = np.cumsum([len(p) + 1 for p in parts])
    first = np.concatenate([[0], np.searchsorted(starts, ends)])
    if not len(starts):
        return np.zeros(0, np.uint64), first
    length = np.diff(np.append(starts, len(data)))
    inside = np.arange(starts[0], len(data)) - np.repeat(starts, length)
    value = _BYTE[data[starts[0] :]]
    value[gap[starts[0] :]] = 0
    value *= _powers(int(length.max()))[inside]
    return mix(np.add.reduceat(value, starts - starts[0])), first


def shingle_sets(texts: list[str], size: int = 3) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a text of fewer words is one
    shingle, a text without words has none."""
    words, first = word_hashes(texts)
    place = np.array(_PLACE[:size], dtype=np.uint64)
    n = max(0, len(words) - size + 1)
    runs = np.full(n, np.uint64(size), dtype=np.uint64)
    for k in range(size):
        runs += words[k : k + n] * place[k]
    runs = mix(runs)
    out = []
    for a, b in zip(first, first[1:], strict=False):
        if b - a >= size:
            out.append(np.unique(runs[a : b - size + 1]))
        elif b > a:
            few = np.array([b - a], dtype=np.uint64) + (words[a:b] * place[: b - a]).sum(dtype=np.uint64)
            out.append(mix(few))
        else:
            out.append(words[:0])
    return out


def set_digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
