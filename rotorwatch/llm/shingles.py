"""Distinct word shingles of texts as 64-bit hashes, for whole slices of texts at once in numpy."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

from rotorwatch.llm.pretokens import flat

WORDS = 5

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_VALUE = np.arange(1, 257, dtype=np.uint64)  # A-Z as a-z, white space as nothing
_VALUE[65:91] += np.uint64(32)
_VALUE[_SPACE] = 0
_BASE, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (runs without ASCII white space, A-Z in lower case), and each text's first (one entry more)."""
    data, borders = flat(texts)
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    inside = ~_SPACE[data]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    opens = borders[:-1][borders[:-1] < n]
    start[opens] |= inside[opens]
    starts = np.flatnonzero(start)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    # a word's bytes times powers by their place in it; white space adds nothing
    span = np.diff(np.concatenate([starts, [n]]))
    place = np.arange(starts[0], n) - np.repeat(starts, span)
    power = np.multiply.accumulate(np.full(int(span.max()) + 1, _BASE))
    values = _VALUE[data[starts[0]:]] * power[place]
    return _mixed(np.add.reduceat(values, starts - starts[0])), np.searchsorted(starts, borders)


def shingle_sets(texts: pa.Array, words: int = WORDS) -> list[np.ndarray]:
    """Each text's distinct shingles, sorted; a text of fewer words has its whole sequence as one, one without words none."""
    hashes, firsts = word_hashes(texts)
    out = []
    rolled = np.zeros(max(0, len(hashes) - words + 1), np.uint64)
    for k in range(words):
        rolled = rolled * _STEP + hashes[k: k + len(rolled)]
    rolled = _mixed(rolled)
    for a, b in zip(firsts[:-1], firsts[1:], strict=True):
        if b - a >= words:
            own = np.sort(rolled[a: b - words + 1])
            if len(own) > 1:
                own = own[np.concatenate([[True], own[1:] != own[:-1]])]
        elif b > a:
            own = np.frombuffer(hashlib.blake2b(hashes[a:b].tobytes(), digest_size=8).digest(), np.uint64)
        else:
            own = rolled[:0]
        out.append(own)
    return out


def signature(own: np.ndarray) -> bytes:
    """128 bits that stand for a whole set."""
    return hashlib.blake2b(own.tobytes(), digest_size=16).digest()
