"""Repeated strings by merging shards' sorted suffixes: numpy work on one batch of pieces.

Text is read in symbols of eight bytes, so one step of the Burrows-Wheeler mapping goes from a suffix to the one that begins
eight bytes before it.  Each shard has its suffixes sorted by prefix doubling; the shards are merged by interleave
refinement: the suffixes of all shards, shard after shard in their own order, are dealt out again and again, stably, by
the symbol before each, so after k rounds they are sorted by their first k symbols, and a block is what has these in
common.  Blocks of a single shard are settled, as that shard's own sort tells their common prefixes, and leave.  Only
suffixes that a whole string precedes are dealt, and many of them in parts that hold all strings of like beginnings, so
the refinement's memory does not follow the number of shards.
"""

from __future__ import annotations

import numpy as np

STEP = 8
PART = 1 << 20  # suffixes refined at once


def _stable(values: np.ndarray) -> np.ndarray:
    """Stable order of non-negative 32-bit values: radix passes of 16 bits."""
    order = np.argsort((values & 0xFFFF).astype(np.uint16), kind="stable")
    high = values >> 16
    return order[np.argsort(high[order].astype(np.uint16), kind="stable")] if high.any() else order


def symbols(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Rank of the eight bytes from each place, as far as its piece goes (zeros beyond); ``ends``: of each place's piece."""
    n = len(data)
    key = np.zeros(n, np.uint64)
    left = np.minimum(ends - np.arange(n, dtype=np.int32), STEP).astype(np.uint8)
    for k in range(STEP):
        key <<= np.uint64(8)
        key[: max(0, n - k)] |= data[k:] * (left[: max(0, n - k)] > k)
    order = np.argsort(key)
    key = key[order]
    rank = np.zeros(n, np.int32)
    np.cumsum(key[1:] != key[:-1], out=rank[1:])
    out = np.empty(n, np.int32)
    out[order] = rank
    return out


def sort_shard(rank: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(order of all suffixes of a shard, whether each shares its first ``length`` bytes with another): prefix doubling.

    ``rank``: symbols of the shard's places, made dense here; places count from 0, as do ``ends``.
    """
    n = len(rank)
    order = _stable(rank)
    held = rank[order]
    first = np.concatenate([[True], held[1:] != held[:-1]]) if n else np.zeros(0, bool)
    starts = np.flatnonzero(first)
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(starts, np.diff(np.concatenate([starts, [n]])))
    covered = STEP

    def follow(places: np.ndarray, by: int) -> np.ndarray:
        out = np.zeros(len(places), np.int64)
        inside = places + by < ends[places]
        out[inside] = rank[places[inside] + by] + 1
        return out

    size = np.diff(np.concatenate([starts, [n]]))
    open_ = order[np.repeat(size > 1, size)]  # places whose group is not single, in order
    while len(open_) and 2 * covered < length:
        key = rank[open_] << 32 | follow(open_, covered)
        by = np.argsort(key, kind="stable")
        open_, key = open_[by], key[by]
        group = rank[open_]
        new = np.concatenate([[True], key[1:] != key[:-1]])
        head = np.concatenate([[True], group[1:] != group[:-1]])
        at = np.arange(len(open_))
        begin = np.maximum.accumulate(np.where(new, at, 0))
        base = np.maximum.accumulate(np.where(head, at, 0))
        fresh = group + begin - base
        order[group + at - base] = open_
        rank[open_] = fresh
        covered *= 2
        starts = np.flatnonzero(new)
        size = np.diff(np.concatenate([starts, [len(open_)]]))
        open_ = open_[np.repeat(size > 1, size)]
    shared = np.zeros(n, bool)
    full = open_[open_ + length <= ends[open_]]
    if len(full):
        # two overlapping prefixes make up the length
        key = rank[full] << 32 | rank[full + length - covered]
        _, back, count = np.unique(key, return_inverse=True, return_counts=True)
        shared[full] = count[back] > 1
    return order, shared


def refine(order: np.ndarray, shard: np.ndarray, begins: np.ndarray, symbol: np.ndarray, length: int, part: int = PART) -> np.ndarray:
    """Places whose first ``length`` bytes occur in more than one shard.

    ``order``: all places, shard after shard, sorted in each; ``shard`` and ``begins`` (of its piece) by place.  Beyond
    ``part`` suffixes they are dealt in parts, by the symbol that their strings begin with.
    """
    full = order[order - begins[order] >= length]
    parts = -(-len(full) // part)
    kind = symbol[full - length] % max(1, parts)
    found = [full[:0]]
    for k in range(parts):
        now = full[kind == k] if parts > 1 else full
        block = np.zeros(len(now), np.int32)
        for _ in range(length // STEP):
            if not len(now):
                break
            now = now - STEP
            s = symbol[now]
            by = _stable(s)
            now, block, s = now[by], block[by], s[by]
            starts = np.flatnonzero(np.concatenate([[True], (s[1:] != s[:-1]) | (block[1:] != block[:-1])]))
            size = np.diff(np.concatenate([starts, [len(now)]]))
            own = shard[now]
            mixed = np.minimum.reduceat(own, starts) != np.maximum.reduceat(own, starts)
            now, block = now[np.repeat(mixed, size)], np.repeat(np.arange(np.count_nonzero(mixed), dtype=np.int32), size[mixed])
        found.append(now)
    return np.concatenate(found)


def repeated(data: np.ndarray, borders: np.ndarray, length: int, shard_bytes: int, part: int = PART) -> np.ndarray:
    """For pieces ``data`` between ``borders``: whether the ``length`` bytes from each place, inside its piece, start anywhere else.

    ``length`` is a multiple of the symbol's eight bytes.
    """
    # a place more at each piece's end, for suffixes that begin there; places fit 32 bits
    size = np.diff(borders).astype(np.int32)
    n = len(data) + len(size)
    begin_of = (borders[:-1] + np.arange(len(size))).astype(np.int32)
    begins, ends = np.repeat(begin_of, size + 1), np.repeat(begin_of + size, size + 1)
    inside = np.arange(n, dtype=np.int32) < ends
    wide = np.zeros(n, np.uint8)
    wide[inside] = data
    symbol = symbols(wide, ends)
    shard = np.repeat((begin_of // shard_bytes).astype(np.int32), size + 1)
    out = np.zeros(n, bool)
    orders = []
    cuts = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1], [True]])) if n else np.zeros(1, int)
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        order, shared = sort_shard(symbol[a:b], ends[a:b] - a, length)
        out[a:b] |= shared
        orders.append((order + a).astype(np.int32))
    if len(orders) > 1:
        out[refine(np.concatenate(orders), shard, begins, symbol, length, part)] = True
    return out[inside]
