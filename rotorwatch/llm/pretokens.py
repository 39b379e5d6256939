"""Pre-token segmentation and cached encoding, shared by the token operators.

A tokenizer maps a text to the concatenation of what it maps each pre-token to, so a batch of texts is cut into
segments at places where the tokenizer always cuts, the segments are dictionary-encoded (Arrow), and only the
distinct ones reach the tokenizer.  Cuts are made only where they are certain:

* between an ASCII white-space run and what follows it (``attach_space=False``) or what precedes it (``True``);
* between letters and other characters, inside a white-space delimited chunk whose characters are all ASCII or
  Latin-1 letters and which has no apostrophe (contractions), no control character and no ``<|`` (special strings).

Any other chunk is handed to the library whole.  Nothing here depends on the texts: results equal the library's.
"""

from __future__ import annotations

import os
import re
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# One thread per Spark task: the library's own pool would oversubscribe the executor's cores.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
os.environ.setdefault("RAYON_NUM_THREADS", "1")

SLICE_BYTES = 2 << 20  # texts are worked on in slices of about this size, so memory does not follow the batch
CACHE_ENTRIES = 200_000  # a worker's cache is emptied beyond this many pre-tokens (a matter of speed alone)
JOINED = 400  # distinct pre-tokens handed to the library in one call

_WS, _LETTER, _OTHER = 0, 1, 2
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = _WS
_CLASS[65:91] = _CLASS[97:123] = _CLASS[128:] = _LETTER
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_CONTROL = np.zeros(256, bool)
_CONTROL[:32] = _CONTROL[127] = True
_CONTROL[[9, 10, 11, 12, 13]] = False
_CONTROL[39] = True  # apostrophe


def text_slices(texts: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """(first row, slice) of about ``size`` bytes each (one text at least); nulls become empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset: texts.offset + len(texts) + 1]
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + size, "right")) - 1)
        yield first, texts.slice(first, last - first)
        first = last


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a large_string slice, and the texts' borders in them."""
    borders = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset: texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[borders[0]: borders[-1]], borders - borders[0]


def segments(texts: pa.Array, attach_space: bool, lower: bool) -> tuple[pa.DictionaryArray | None, np.ndarray]:
    """Dictionary-encoded segments of all texts in order, and the index of each text's first (one entry more).

    ``lower``: ASCII and Latin-1 capitals become small in segments that are cut finely.
    """
    data, borders = flat(texts)
    n = len(data)
    if not n:
        return None, np.zeros(len(texts) + 1, np.int64)
    kind = _CLASS[data]
    cut = np.empty(n, bool)
    cut[0] = True
    np.not_equal(kind[1:], kind[:-1], out=cut[1:])
    doc_starts = borders[:-1][borders[:-1] < n]
    cut[doc_starts] = True
    runs = np.flatnonzero(cut).astype(np.int32)
    run_kind = kind[runs]
    at_doc = np.zeros(len(runs), bool)
    at_doc[np.searchsorted(runs, doc_starts)] = True

    # bytes that may not be cut around
    odd = _CONTROL[data]
    special = np.flatnonzero(data == 60)  # <
    special = special[special + 1 < n]
    odd[special[data[special + 1] == 124]] = True
    high = data >= 128
    if high.any():
        lead = data == 0xC3
        fine = np.zeros(n, bool)
        fine[1:] = lead[:-1] & (data[1:] != 0x97) & (data[1:] != 0xB7)
        odd |= high & ~lead & ~fine

    # chunk: an optional white-space run, then the runs up to the next white space or the text's end
    space = run_kind == _WS
    before = np.concatenate([[False], space[:-1]])
    opens = at_doc | space if attach_space else at_doc | space | before
    chunk = np.cumsum(opens, dtype=np.int32) - 1
    flagged = np.zeros(int(chunk[-1]) + 1, bool)
    flagged[chunk[np.searchsorted(runs, np.flatnonzero(odd), "right") - 1]] = True
    first_run = np.flatnonzero(opens)
    whole = flagged[chunk]
    # a finely cut chunk opens a segment at each run, but not after the white space that belongs to it
    keep = opens | ~whole
    if attach_space:
        keep &= opens | ~(before & ~at_doc)
        # what ends in an unusual character may be white space to the tokenizer: no cut after it
        ends = np.concatenate([first_run[1:], [len(runs)]])
        last_byte = data[np.concatenate([runs, [n]])[ends] - 1]
        sticky = flagged & ((last_byte >= 128) | (last_byte < 32))
        glued = np.flatnonzero(sticky[:-1]) + 1
        glued = glued[~at_doc[first_run[glued]]]
        if len(glued):
            joined = np.zeros(len(flagged), bool)
            joined[glued] = True
            keep &= ~joined[chunk]  # the next chunk goes whole with the one before
            again = np.flatnonzero(joined)  # and, glued, may end in such a character too: join on
            while len(again):
                nxt = again + 1
                nxt = nxt[nxt < len(flagged)]
                nxt = nxt[~joined[nxt] & ~at_doc[first_run[nxt]]]
                tail = last_byte[nxt - 1]
                nxt = nxt[(tail >= 128) | (tail < 32)]
                joined[nxt] = True
                keep &= ~(joined[chunk])
                again = nxt
            whole |= joined[chunk]
    starts = runs[keep]
    if lower:
        small = _LOWER[data]
        capital = np.flatnonzero((small[1:] >= 0x80) & (small[1:] <= 0x9E) & (small[:-1] == 0xC3)) + 1
        small[capital] += 32
        if flagged.any():
            back = np.repeat(whole, np.diff(np.concatenate([runs, [n]])))
            small[back] = data[back]
        data = small
    offsets = np.concatenate([starts, [n]]).astype(np.int32)
    cells = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])
    return cells.dictionary_encode(), np.searchsorted(starts, borders)


def words(texts: pa.Array) -> tuple[pa.BinaryArray, np.ndarray, np.ndarray]:
    """Distinct lower-cased words (runs without ASCII white space), each word's place among them in order, and the
    index of each text's first (one entry more)."""
    data, borders = flat(texts)
    n = len(data)
    space = _CLASS[data] == _WS
    cut = np.empty(n, bool)
    cut[:1] = True
    np.not_equal(space[1:], space[:-1], out=cut[1:])
    cut[borders[:-1][borders[:-1] < n]] = True
    starts = np.flatnonzero(cut)
    small = _LOWER[data]
    capital = np.flatnonzero((small[1:] >= 0x80) & (small[1:] <= 0x9E) & (small[1:] != 0x97) & (small[:-1] == 0xC3)) + 1
    small[capital] += 32
    offsets = np.concatenate([starts, [n]]).astype(np.int32)
    cells = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(small)]).dictionary_encode()
    inside = ~space[starts]
    return cells.dictionary, cells.indices.to_numpy()[inside], np.concatenate([[0], np.cumsum(inside)])[np.searchsorted(starts, borders)]


class _Store:
    """Growing arrays: ids of all cached pre-tokens, and where each one's ids start."""

    def __init__(self) -> None:
        self.index: dict[bytes, int] = {}
        self.ids = np.zeros(1 << 16, np.int32)
        self.starts = np.zeros(1 << 14, np.int64)
        self.used = 0
        self.seen = np.zeros(0, bool)  # asked for again after it was added, where that is kept

    def again(self, places: np.ndarray) -> None:
        """Note that these were asked for; those added since the last call are not held to be asked for again."""
        old = len(self.seen)
        self.seen = np.concatenate([self.seen, np.zeros(len(self.index) - old, bool)])
        self.seen[places[places < old]] = True

    def recurring(self) -> _Store:
        """A store of the pre-tokens that were asked for again, in place of this one."""
        left, keys = _Store(), [k for k, s in zip(self.index, self.seen.tolist(), strict=True) if s]
        at = np.flatnonzero(self.seen)
        lengths = self.starts[at + 1] - self.starts[at]
        ends = np.cumsum(lengths)
        from_ = np.repeat(self.starts[at] - (ends - lengths), lengths) + np.arange(int(lengths.sum()))
        left.add(keys, self.ids[from_], lengths)
        left.seen = np.zeros(len(keys), bool)
        return left

    def add(self, keys: list[bytes], ids: np.ndarray, lengths: np.ndarray) -> None:
        total, n = self.used + len(ids), len(self.index)
        while total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while n + len(keys) + 1 > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
        self.ids[self.used: total] = ids
        self.starts[n + 1: n + 1 + len(keys)] = self.used + np.cumsum(lengths)
        self.index.update(zip(keys, range(n, n + len(keys)), strict=True))
        self.used = total


class Encoder:
    """Ids of texts under a ``tokenizers`` file, by way of distinct segments and a worker-wide cache.

    ``attach_space`` and ``lower`` say how the file's pre-tokenizer treats white space and capitals; see
    :func:`word_encoder` and :func:`byte_encoder`.  Special strings inside texts are handled as the library does.
    ``retain``: a full cache keeps the pre-tokens that recurred, up to half its size, and gives up the others.
    """

    def __init__(self, path: str, attach_space: bool, lower: bool, retain: bool = False) -> None:
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.attach_space, self.lower, self.retain = attach_space, lower, retain
        self.full = Tokenizer.from_file(path)
        self.store = _Store()
        vocabulary = self.full.get_vocab()
        self.size = max(vocabulary.values()) + 1
        # a run of small Latin letters is left alone by normalizer and pattern, so many are encoded in one call;
        # the marker tells where one ends (the word-end suffix) or begins (the attached space)
        self.marks = np.zeros(self.size, bool)
        if attach_space:
            self.marks[[i for t, i in vocabulary.items() if t.startswith("Ġ")]] = True
            self.plain, self.many = re.compile(r" [A-Za-zÀ-ÖØ-öø-ÿ]+"), self.full
        else:
            self.marks[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
            self.plain, self.many = re.compile(r"[a-zß-öø-ÿ]+"), Tokenizer.from_file(path)
            self.many.normalizer = normalizers.Sequence([])
            self.many.pre_tokenizer = pre_tokenizers.Sequence([
                pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])

    def _encode(self, keys: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """Keys (regrouped), all their ids, and how many each has."""
        text = [k.decode("utf-8", "replace") for k in keys]
        plain = [bool(self.plain.fullmatch(t)) for t in text]
        simple, rest = [t for t, p in zip(text, plain, strict=True) if p], [t for t, p in zip(text, plain, strict=True) if not p]
        ids, lengths = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        if simple:
            glue = "" if self.attach_space else " "
            for e in self.many.encode_batch_fast([glue.join(simple[i: i + JOINED]) for i in range(0, len(simple), JOINED)], add_special_tokens=False):
                a = np.array(e.ids, np.int32)
                at = np.flatnonzero(self.marks[a])
                lengths.append(np.diff(np.concatenate([at, [len(a)]])) if self.attach_space else np.diff(np.concatenate([[-1], at])))
                ids.append(a)
        for i in range(0, len(rest), JOINED):
            for e in self.full.encode_batch_fast(rest[i: i + JOINED], add_special_tokens=False):
                a = np.array(e.ids, np.int32)
                ids.append(a)
                lengths.append(np.array([len(a)]))
        order = [k for k, p in zip(keys, plain, strict=True) if p] + [k for k, p in zip(keys, plain, strict=True) if not p]
        return order, np.concatenate(ids), np.concatenate(lengths)

    def cached(self, keys: list[bytes]) -> np.ndarray:
        """Places of the keys in the store; misses are encoded first."""
        if len(self.store.index) > CACHE_ENTRIES:
            self.store = self.store.recurring() if self.retain and np.count_nonzero(self.store.seen) <= CACHE_ENTRIES // 2 else _Store()
        known = self.store.index
        misses = [k for k in keys if k not in known]
        if misses:
            order, ids, lengths = self._encode(misses)
            if len(lengths) != len(order):
                raise RuntimeError("the tokenizer split a pre-token differently from its own pattern")
            self.store.add(order, ids, lengths)
        places = np.fromiter((known[k] for k in keys), np.int64, len(keys))
        if self.retain:
            self.store.again(places)
        return places

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (a slice of :func:`text_slices`) one after the other, and the texts' borders in them."""
        cells, firsts = segments(texts, self.attach_space, self.lower)
        if cells is None:
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        place = self.cached(cells.dictionary.to_pylist())
        store, of = self.store, cells.indices.to_numpy()
        start = store.starts[place].astype(np.int32)
        each = (store.starts[place + 1] - store.starts[place]).astype(np.int32)[of]
        ends = np.cumsum(each, dtype=np.int32)
        borders = np.concatenate([np.zeros(1, np.int32), ends])[firsts]
        some = np.flatnonzero(each)
        of, each, ends = of[some], each[some], ends[some]
        if not len(some):
            return np.zeros(0, np.int32), borders.astype(np.int64)
        # steps of one within a pre-token, and from the last id of one to the first of the next
        step = np.ones(ends[-1], np.int32)
        at = start[of]
        step[0] = at[0]
        step[ends[:-1]] = at[1:] - (at[:-1] + each[:-1]) + 1
        return store.ids[np.cumsum(step, out=step)], borders.astype(np.int64)


def worker_cache() -> dict:
    """What a worker process keeps from task to task.  The package reaches executors by value, so its own globals are new in
    each task; a module made in the worker stays."""
    return vars(sys.modules.setdefault("_rotorwatch_worker", types.ModuleType("_rotorwatch_worker"))).setdefault("cache", {})


def _encoder(path: str, attach_space: bool, lower: bool, retain: bool = False) -> Encoder:
    """One per worker process and file: it stays from task to task."""
    cache, key = worker_cache(), (path, attach_space, lower, retain)
    if key not in cache:
        cache[key] = Encoder(*key)
    return cache[key]


def word_encoder(path: str, retain: bool = False) -> Encoder:
    """For a file that drops white space, lower-cases, and marks word ends (``</w>``)."""
    return _encoder(path, False, True, retain)


def byte_encoder(path: str) -> Encoder:
    """For a byte-level file whose pre-tokens carry one leading space."""
    return _encoder(path, True, False)
