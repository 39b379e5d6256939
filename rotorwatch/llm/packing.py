"""Packing: harmonic classes, filled by each worker on its own (operator 3).

The capacity C is cut in reciprocal classes C/1, C/2, C/4 ... C/32 (with C a power of two); a sequence of class C/k takes
exactly k pieces.  A document is cut into pieces of class size, the largest first, so class sequences have no gaps; what
is left, shorter than the least class, goes to a last class whose sequences are filled next-fit, cutting at their ends.
At the end of a task, the sequence that each class has begun is dealt out to sequences of powers of two, which need no
padding.  Tasks share nothing, so there is no shuffle, and a task holds a slice of texts and one open sequence a class.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from rotorwatch.llm import pretokens
from rotorwatch.llm.common import arrow_rows, tidy

CAPACITY = 2048
CLASSES = 6  # capacity / 1, 2, 4 ... 32; one more for what is shorter


def pieces(tokens: np.ndarray, capacity: int, classes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Cut documents of ``tokens`` ids: (document, class, start, length) of each piece, by document and start."""
    docs, kinds, lengths = [], [], []
    whole = tokens // capacity
    docs.append(np.repeat(np.arange(len(tokens)), whole))
    kinds.append(np.zeros(len(docs[0]), np.int64))
    lengths.append(np.full(len(docs[0]), capacity))
    rest = tokens % capacity
    for kind in range(1, classes):
        size = capacity >> kind
        has = np.flatnonzero(rest >= size)
        docs.append(has)
        kinds.append(np.full(len(has), kind))
        lengths.append(np.full(len(has), size))
        rest[has] -= size
    has = np.flatnonzero(rest)
    docs.append(has)
    kinds.append(np.full(len(has), classes))
    lengths.append(rest[has])
    doc, kind, length = (np.concatenate(x).astype(np.int64) for x in (docs, kinds, lengths))
    order = np.argsort(doc, kind="stable")
    doc, kind, length = doc[order], kind[order], length[order]
    ahead = np.cumsum(length) - length
    first = np.searchsorted(doc, doc)
    return doc, kind, ahead - ahead[first], length


def place(lengths: np.ndarray, capacity: int, last: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lay pieces end to end and cut at the sequences' ends: (piece, skip, length, sequence, offset) of each part.

    The sequences are of the whole capacity; with ``last``, what is over makes sequences of its powers of two, else it
    stays out.
    """
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    full, over = divmod(total, capacity)
    cuts = [np.arange(1, full + 1) * capacity]
    if last and over:
        cuts.append(full * capacity + np.cumsum([b for b in (1 << k for k in range(capacity.bit_length(), -1, -1)) if over & b]))
    cuts = np.concatenate(cuts).astype(np.int64)
    stop = int(cuts[-1]) if len(cuts) else 0
    borders = np.union1d(np.concatenate([[0], ends[ends < stop]]), cuts) if stop else np.zeros(1, np.int64)
    begin, end = borders[:-1], borders[1:]
    piece = np.searchsorted(ends, begin, "right")
    sequence = np.searchsorted(cuts, begin, "right")
    opened = np.concatenate([[0], cuts])[sequence]
    return piece, begin - (ends[piece] - lengths[piece]) if len(piece) else piece, end - begin, sequence, begin - opened


def pack(docs: DataFrame, path: str, end_id: int = 1, capacity: int = CAPACITY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Token ids of every whole text, and ``end_id`` after each, in sequences of at most ``capacity`` ids (a power of two).

    A row per piece: doc_id, start (ids of its row before it), length, ids (little-endian unsigned 32-bit), doc_tokens,
    sequence_id (its task's number, class and count), offset in the sequence, gapless from 0.  A null or empty text is
    its end id alone; null ids and repeated rows are documents of their own; an empty table gives no rows; other columns
    of ``docs`` are not read.  Sequences are full or hold a power of two.
    """
    if capacity & (capacity - 1) or capacity < 1 << CLASSES:
        raise ValueError(f"capacity {capacity} must be a power of two, {1 << CLASSES} at least")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task = pretokens.word_encoder(path), TaskContext.get().partitionId()
        used = [0] * (CLASSES + 1)
        open_ = [None] * (CLASSES + 1)  # by class: (names, start, ids of each, doc_tokens) of what no full sequence has
        kind_of_id = None

        def emit(kind: int, names: pa.Array, start: np.ndarray, length: np.ndarray, ids: np.ndarray, tokens: np.ndarray, last: bool) -> Iterator[pa.RecordBatch]:
            """``ids``: those of all pieces, one after the other."""
            ahead = np.cumsum(length) - length
            piece, skip, size, sequence, offset = place(length, capacity, last)
            begin = ahead[piece] + skip if len(piece) else piece
            done = int(size.sum())
            if done:
                cells = pa.Array.from_buffers(pa.binary(), len(piece), [None, pa.py_buffer((np.concatenate([begin, [done]]) * 4).astype(np.int32)), pa.py_buffer(ids[:done].astype("<u4"))])
                number = (np.int64(task) << 34) + (np.int64(kind) << 30) + used[kind] + sequence
                yield pa.RecordBatch.from_arrays([names.take(pa.array(piece)), pa.array(start[piece] + skip), pa.array(size), cells, pa.array(tokens[piece]), pa.array(number), pa.array(offset)], names=[doc_id, "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])
                used[kind] += int(sequence[-1]) + 1
            # the rest begins in the piece that the last cut went through, or after it
            ends = ahead + length
            left = int(np.searchsorted(ends, done, "right"))
            if left < len(length):
                skip = done - ahead[left]
                more, longer = start[left:].copy(), length[left:].copy()
                more[0] += skip
                longer[0] -= skip
                open_[kind] = names.slice(left), more, longer, ids[done:], tokens[left:]
            else:
                open_[kind] = None

        for batch in batches:
            kind_of_id = batch.column(0).type
            for first, part in pretokens.text_slices(batch.column(1)):
                ids, borders = encoder.ids(part)
                ids = np.insert(ids, borders[1:], end_id)
                borders = borders + np.arange(len(borders))
                tokens = np.diff(borders)
                doc, kinds, start, length = pieces(tokens, capacity, CLASSES)
                names = batch.column(0).slice(first, len(part))
                for kind in range(CLASSES + 1):
                    own = np.flatnonzero(kinds == kind)
                    if not len(own):
                        continue
                    size = length[own]
                    ends = np.cumsum(size)
                    # places of the class's ids, piece after piece
                    at = np.repeat(borders[doc[own]] + start[own] - (ends - size), size) + np.arange(ends[-1])
                    new = names.take(pa.array(doc[own])), start[own], size, ids[at], tokens[doc[own]]
                    if (old := open_[kind]) is not None:
                        new = pa.concat_arrays([old[0], new[0]]), *(np.concatenate([a, b]) for a, b in zip(old[1:], new[1:], strict=True))
                    yield from emit(kind, *new, last=False)
        for kind in range(CLASSES + 1):
            if open_[kind] is not None:
                yield from emit(kind, *open_[kind], last=True)

    out = T.StructType([docs.schema[doc_id], *(T.StructField(c, T.LongType()) for c in ("start", "length")), T.StructField("ids", T.BinaryType()), *(T.StructField(c, T.LongType()) for c in ("doc_tokens", "sequence_id", "offset"))])
    return arrow_rows(docs, doc_id, text).mapInArrow(tidy(work), out)
