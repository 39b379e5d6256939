"""Removal of repeated passages: suffixes of shards merged by interleave refinement (operator 10).

A string of ``length`` bytes holds one anchor: of its 64-byte substrings the one with the least hash, the first of equal
ones.  Equal strings have equal anchors at equal places, so strings are compared only where they share an anchor, and
every text is cut into pieces: all strings that have the same anchor, one after the other.  Pieces whose anchor occurs
once hold nothing repeated.  Pieces that are equal as a whole are repeated as a whole.  Of the others, a copy of each
goes to the task of its anchor, where shards of pieces have their suffixes sorted and are merged
(:mod:`rotorwatch.llm.interleave`): a block of suffixes with ``length`` bytes in common is a repeated string.  Pieces of
an anchor that has more different ones than a task should hold are compared string by string, by digest, in all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rotorwatch.llm import interleave
from rotorwatch.llm.common import arrow_rows, kept, tidy
from rotorwatch.llm.pretokens import flat, text_slices, worker_cache

LENGTH = 400
ANCHOR = 64
PART = 1 << 20  # bytes of a text worked on at once
SHARD, BATCH = 1 << 19, 1 << 20  # bytes of pieces: sorted at once, merged at once
CROWD = 8_192  # different pieces of an anchor beyond which strings are compared by digest

_BASE = 0x9E3779B97F4A7C15
_VALUE = np.array([(k + 1) * 0xD6E8FEB86659FD93 * (2 * k + 3) % (1 << 64) for k in range(256)], np.uint64)


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the base, and of its inverse modulo 2**64, up to the n-th at least."""
    cache = worker_cache()
    if len(cache.get("powers", [""])[0]) <= n:
        one = np.ones(1, np.uint64)
        size = max(n, PART + LENGTH) + 1
        cache["powers"] = [np.multiply.accumulate(np.concatenate([one, np.full(size, b, np.uint64)])) for b in (_BASE, pow(_BASE, -1, 1 << 64))]
    return cache["powers"]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Strings:
    """Digests of any substrings of some bytes, from prefix sums."""

    def __init__(self, data: np.ndarray) -> None:
        power, self.inverse = _powers(len(data))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_VALUE[data] * power[: len(data)], out=self.sums[1:])

    def digests(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[end] - self.sums[begin]) * self.inverse[begin])


def anchored(data: np.ndarray, borders: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(text, anchor's hash, piece's digest, first and last start of the piece's strings, anchor's place) of all pieces of the
    texts between ``borders``; places count from the start of ``data``, which is shorter than 2**24."""
    n, width = len(data), length - gram + 1
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none.astype(np.uint64), none.astype(np.uint64), none, none, none
    strings = Strings(data)
    hashes = _mixed((strings.sums[gram:] - strings.sums[: n - gram + 1]) * strings.inverse[: n - gram + 1])
    # the least hash, then the first place, of each string: minima over doubling widths
    least = hashes >> np.uint64(24) << np.uint64(24) | np.arange(len(hashes), dtype=np.uint64)
    size = 1
    while 2 * size <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < width:
        least = np.minimum(least[: len(least) - (width - size)], least[width - size:])
    inside = np.zeros(n + 1, np.int32)
    begin, end = borders[:-1], borders[1:] - length + 1
    some = end > begin
    np.add.at(inside, begin[some], 1)
    np.add.at(inside, end[some], -1)
    starts = np.flatnonzero(np.cumsum(inside[:n]) > 0)
    if not len(starts):
        return none, none.astype(np.uint64), none.astype(np.uint64), none, none, none
    at = (least[starts] & np.uint64((1 << 24) - 1)).astype(np.int64)
    text = np.searchsorted(borders, starts, "right") - 1
    new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (text[1:] != text[:-1])]))
    first, last = starts[new], starts[np.concatenate([new[1:] - 1, [len(starts) - 1]])]
    at = at[new]
    whole = _mixed(strings.digests(first, last + length) + ((at - first) << 32).astype(np.uint64) + (last - first).astype(np.uint64))
    return text[new], hashes[at], whole, first, last, at


def numbered(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(row, id, text): the rows of ``docs`` under numbers of their own, written, so that every later step tells them apart by one long."""
    return kept(docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")), "repeat-texts", "zstd")


def pieces(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """(row, anchor, whole, first, last, at): the pieces of all texts; places are in the text, ``at`` counts from ``first``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, part in text_slices(batch.column(1), PART):
                data, borders = flat(part)
                # a text longer than a part is cut so that each string lies in one cut as a whole
                for a in range(0, max(1, len(data) - length + 1), PART if len(part) == 1 else max(1, len(data))):
                    cut = data[a: a + PART + length - 1] if len(part) == 1 else data
                    of, anchor, whole, first, last, at = anchored(cut, np.array([0, len(cut)]) if len(part) == 1 else borders, length, gram)
                    zero = borders[of] - a if len(part) > 1 else np.full(len(of), -a)
                    cells = [pa.array(x) for x in (np.asarray(batch.column(0))[row + of], anchor.view(np.int64), whole.view(np.int64), first - zero, last - zero, (at - first).astype(np.int32))]
                    yield pa.RecordBatch.from_arrays(cells, names=["row", "anchor", "whole", "first", "last", "at"])

    return arrow_rows(rows.where(F.octet_length("text") >= length), "row", "text").mapInArrow(tidy(work), "row long, anchor long, whole long, first long, last long, at int")


def cut_out(rows: DataFrame, wanted: DataFrame, length: int, crowd: int) -> DataFrame:
    """(anchor, string, row, first, single, piece): the bytes of the ``wanted`` pieces, or, where an anchor has a crowd of them,
    a row for each string with its digest and no bytes."""
    by_text = wanted.groupBy(F.col("row").alias("_row")).agg(F.collect_list(F.struct("anchor", "first", "last", "at", "single", "kinds")).alias("_cuts"))
    rows = rows.join(by_text, F.col("row") == F.col("_row"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                data = np.frombuffer(batch.column(1)[row].as_buffer(), np.uint8)
                cuts = batch.column(2)[row].values
                anchor, first, last, at, single, kinds = (np.asarray(cuts.field(k)) for k in range(6))
                where, digest, piece = [], [], []
                for k in range(len(anchor)):
                    if kinds[k] <= crowd:
                        where.append((k, int(first[k])))
                        digest.append(None)
                        piece.append(data[first[k]: last[k] + length].tobytes())
                    else:
                        begin = np.arange(last[k] - first[k] + 1)
                        own = Strings(data[first[k]: last[k] + length]).digests(begin, begin + length)
                        own = _mixed(own + (at[k] - begin).astype(np.uint64)).view(np.int64)
                        where += [(k, int(first[k] + b)) for b in begin]
                        digest += own.tolist()
                        piece += [None] * len(begin)
                if not where:
                    continue
                k = np.array([w[0] for w in where])
                number = np.full(len(k), batch.column(0)[row].as_py())
                yield pa.RecordBatch.from_arrays([pa.array(anchor[k]), pa.array(digest, pa.int64()), pa.array(number), pa.array([w[1] for w in where], pa.int64()), pa.array(single[k]), pa.array(piece, pa.binary())], names=["anchor", "string", "row", "first", "single", "piece"])

    out = "anchor long, string long, row long, first long, single boolean, piece binary"
    return arrow_rows(rows, "row", "text", "_cuts").mapInArrow(tidy(work), out)


def merged(cut: DataFrame, length: int, shard: int, batch_bytes: int) -> DataFrame:
    """(row, first, last): runs of starts of repeated strings in the pieces that occur once."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(rows).combine_chunks()
            column = table.column(4).chunk(0).cast(pa.large_binary())
            data, borders = flat(column)
            hit = interleave.repeated(data, borders, length, shard)
            single = np.asarray(table.column(3))
            piece = np.repeat(np.arange(len(single), dtype=np.int32), np.diff(borders))
            at = np.flatnonzero(hit & single[piece])
            new = np.concatenate([[True], (at[1:] != at[:-1] + 1) | (piece[at[1:]] != piece[at[:-1]])]) if len(at) else np.zeros(0, bool)
            first = at[new]
            last = at[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(at) - 1]])] if len(at) else first
            of = piece[first]
            zero = np.asarray(table.column(2))[of] - borders[of]
            return pa.RecordBatch.from_arrays([table.column(1).chunk(0).take(pa.array(of)), pa.array(first + zero), pa.array(last + zero)], names=["row", "first", "last"])

        waiting, held = [], 0
        for batch in batches:
            anchor = np.asarray(batch.column(0))
            ends = np.concatenate([np.flatnonzero(anchor[1:] != anchor[:-1]) + 1, [len(anchor)]]) if len(anchor) else []
            begin = 0
            for end in ends:
                group = batch.slice(begin, end - begin)
                # the last group may go on in the next batch, so a flush comes before a group of another anchor
                size = pc.sum(pc.binary_length(group.column(4))).as_py()
                if held and held + size > batch_bytes and waiting[-1].column(0)[-1] != group.column(0)[0]:
                    yield flush(waiting)
                    waiting, held = [], 0
                waiting.append(group)
                held += size
                begin = end
        if waiting:
            yield flush(waiting)

    rows = cut.select("anchor", "row", "first", "single", "piece").repartition("anchor").sortWithinPartitions("anchor")
    return arrow_rows(rows, "*").mapInArrow(tidy(work), "row long, first long, last long")


def repeated_starts(texts: DataFrame, length: int, gram: int, crowd: int, shard: int, batch: int) -> DataFrame:
    """(row, first, last): runs of starts of repeated strings in the ``numbered`` texts."""
    found = kept(pieces(texts, length, gram), "repeat-all-pieces", "zstd")
    # written, so that the join below has plain shuffles on both sides, whose skewed keys Spark can split
    often = kept(found.groupBy(F.col("anchor").alias("_a")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_a"), "repeat-anchors")
    found = kept(found.join(often, F.col("anchor") == F.col("_a")).drop("_a"), "repeat-pieces")
    kinds = found.groupBy("anchor", "whole").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("row", "first", "last", "at")).alias("one"))
    by_anchor = kinds.groupBy(F.col("anchor").alias("_a")).agg(F.count(F.lit(1)).alias("kinds"))
    kinds = kept(kinds.join(by_anchor, F.col("anchor") == F.col("_a")).drop("_a"), "repeat-kinds")

    equal = kinds.where("n > 1").select(F.col("anchor").alias("_a"), F.col("whole").alias("_w"))
    starts = found.join(equal, (F.col("anchor") == F.col("_a")) & (F.col("whole") == F.col("_w"))).select("row", "first", "last")

    wanted = kinds.where("kinds > 1").select("anchor", "one.*", (F.col("n") == 1).alias("single"), "kinds")
    cut = cut_out(texts, wanted, length, crowd)
    if not kinds.where(F.col("kinds") > crowd).limit(1).count():
        return starts.unionByName(merged(cut, length, shard, batch))
    cut = kept(cut, "repeat-cuts")
    crowded = cut.where("piece IS NULL")
    twice = crowded.groupBy(F.col("anchor").alias("_a"), F.col("string").alias("_s")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    crowded = crowded.where("single").join(twice, (F.col("anchor") == F.col("_a")) & (F.col("string") == F.col("_s")))
    starts = starts.unionByName(crowded.select("row", "first", F.col("first").alias("last")))
    return starts.unionByName(merged(cut.where("piece IS NOT NULL"), length, shard, batch))


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = ANCHOR, crowd: int = CROWD, shard: int = SHARD, batch: int = BATCH) -> DataFrame:
    """(doc_id, n_bytes, spans, kept): a row per row of ``docs``.  ``spans`` are the maximal runs of bytes covered by strings of
    ``length`` bytes that also start anywhere else, in the same text or another; ``kept`` are the bytes left.

    Texts are UTF-8 bytes as a whole; null is empty; strings are judged on the input, overlaps count, and none crosses
    texts.  Rows that repeat an id and text repeat each other; null ids are ids; an empty table gives no rows; other
    columns of ``docs`` are not read.  ``length`` is a multiple of eight, more than ``gram``.
    """
    if length % interleave.STEP or gram >= length:
        raise ValueError(f"length {length} must be a multiple of {interleave.STEP} and exceed {gram}")
    texts = numbered(docs, doc_id, text)
    starts = repeated_starts(texts, length, gram, crowd, shard, batch)
    by_text = starts.groupBy(F.col("row").alias("_row")).agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("_starts"))
    rows = texts.join(by_text, F.col("row") == F.col("_row"), "left")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, spans, rest = [], [], []
            for row in range(batch.num_rows):
                raw = batch.column(1)[row].as_buffer()
                runs, left, done = [], [], 0
                if batch.column(2)[row].is_valid:
                    cells = batch.column(2)[row].values
                    first, end = np.asarray(cells.field(0)), np.maximum.accumulate(np.asarray(cells.field(1)) + length)
                    opens = np.flatnonzero(np.concatenate([[True], first[1:] > end[:-1]]))
                    closes = np.concatenate([opens[1:] - 1, [len(first) - 1]])
                    runs = list(zip(first[opens].tolist(), end[closes].tolist(), strict=True))
                view = memoryview(raw)
                for a, b in runs:
                    left.append(view[done:a])
                    done = b
                left.append(view[done:])
                sizes.append(len(view))
                spans.append([{"begin": a, "end": b} for a, b in runs])
                rest.append(b"".join(left))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(spans, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))), pa.array(rest, pa.binary())], names=[doc_id, "n_bytes", "spans", "kept"])

    span = T.StructType([T.StructField("begin", T.LongType()), T.StructField("end", T.LongType())])
    out = T.StructType([docs.schema[doc_id], T.StructField("n_bytes", T.LongType()), T.StructField("spans", T.ArrayType(span)), T.StructField("kept", T.BinaryType())])
    return arrow_rows(rows, F.col("id").alias(doc_id), "text", "_starts").mapInArrow(tidy(work), out)
