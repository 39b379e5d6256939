"""Source divergence audit over count-level bitmaps (operator 13).

Each language keeps the terms of at least three of its documents.  Their counts by group (a source in a language) are kept as
levels: the set of term ids that have one count in one group, inside blocks of terms of like frequency, so that a block
has few levels.  A pair of groups' joint cells are the popcounts of two levels' AND; terms that a group lacks are the
complement of its levels.  A cell's size times f, which depends on the two counts alone, adds up to the divergence.
All arithmetic is in integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from rotorwatch.llm.common import arrow_rows, kept, tidy
from rotorwatch.llm.pretokens import flat, text_slices

SCALE = 1_000_000_000
MIN_DOCS = 3
TOP = 200
CELLS = 1 << 19  # terms times groups of a block, about
SPARSE = 128  # a level of less than this part of its block is looked up id by id; others are ANDed
SLICE = 8 << 20  # bytes of text that are summed up at once

_FOLD = np.arange(256, dtype=np.uint8)  # A-Z as a-z
_FOLD[65:91] += 32
_TERM = np.zeros(256, bool)  # bytes of terms: letters, and all of characters outside ASCII
_TERM[65:91] = _TERM[97:123] = _TERM[128:] = True


def terms_of(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All terms of a slice of texts, dictionary-encoded, and the index of each one's text."""
    data, borders = flat(texts)
    inside = _TERM[data]
    edge = np.diff(inside.astype(np.int8), prepend=0)
    start = edge == 1
    opens = borders[:-1][borders[:-1] < len(data)]
    start[opens] |= inside[opens]  # a term ends with its text
    starts = np.flatnonzero(start)
    size = np.add.reduceat(inside, starts, dtype=np.int64) if len(starts) else np.zeros(0, np.int64)
    ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    terms = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(_FOLD[data[inside]])])
    return terms.dictionary_encode(), np.searchsorted(borders, starts, "right") - 1


def term_counts(docs: DataFrame, lang: str, source: str, text: str) -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and documents with the term, by group; each slice of text is summed up before
    anything is shuffled."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in text_slices(batch.column(2), SLICE):
                cells, of = terms_of(texts)
                words = len(cells.dictionary)
                if not words:
                    continue
                mine = [batch.column(c).slice(at, len(texts)) for c in (0, 1)]
                codes = [m.dictionary_encode() for m in mine]
                pair = codes[0].indices.to_numpy().astype(np.int64) * len(codes[1].dictionary) + codes[1].indices.to_numpy()
                _, row_of, group = np.unique(pair, return_index=True, return_inverse=True)
                in_doc, n = np.unique(of * words + cells.indices.to_numpy(), return_counts=True)
                spot, back = np.unique(group[in_doc // words] * words + in_doc % words, return_inverse=True)
                row = pa.array(row_of[spot // words])
                yield pa.RecordBatch.from_arrays(
                    [*(m.take(row) for m in mine), cells.dictionary.take(pa.array(spot % words)).cast(pa.large_string()).cast(pa.string()),
                     pa.array(np.bincount(back, n).astype(np.int64)), pa.array(np.bincount(back).astype(np.int64))], names=["lang", "source", "term", "n", "docs"])

    rows = arrow_rows(docs, *(F.coalesce(F.col(c), F.lit("")).alias(c) for c in (lang, source)), text)
    parts = rows.mapInArrow(tidy(work), "lang string, source string, term string, n long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + 1) / (total + terms)), exactly, for counts of any size."""
    up = (F.lit(SCALE).cast("decimal(10,0)") * (count + 1).cast("decimal(19,0)")).cast("decimal(38,0)")
    return F.lit(1) + F.call_function("div", up, (total + terms).cast("decimal(20,0)"))


def divergence(p: Column, q: Column) -> Column:
    """floor((p - q) ** 2 / q)."""
    return F.call_function("div", (p - q) * (p - q), q)


def _bitmap(ids: np.ndarray) -> np.ndarray:
    """Words of 64 bits with the bits of ``ids`` (rising) set."""
    bits = np.zeros(64 * (int(ids[-1]) // 64 + 1), bool)
    bits[ids] = True
    return np.packbits(bits, bitorder="little").view(np.uint64)


def levels_of(terms: DataFrame) -> DataFrame:
    """(lang, block, source, n, p, bitmap, ids): a row per group, block and count, with the block's term ids of that count as a
    bitmap or, where that is shorter, as a list.  ``terms`` must be sorted by lang, block, source, n and id."""
    keys = ["lang", "block", "source", "n"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = None
        for last, batch in _with_last(batches):
            rows = pa.concat_batches([left, batch]) if left is not None else batch
            if not rows.num_rows:
                continue
            change = np.zeros(rows.num_rows, bool)
            change[0] = True
            for c in rows.columns[:4]:
                change[1:] |= pc.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False)
            begins = np.flatnonzero(change)
            ends = np.append(begins[1:], rows.num_rows)
            if not last:  # the last level may go on in the next batch
                left = rows.slice(begins[-1])
                begins, ends = begins[:-1], ends[:-1]
            ids = rows.column(5).to_numpy()
            own = [ids[a:b] for a, b in zip(begins, ends, strict=True)]
            listed = [32 * len(x) < x[-1] for x in own]
            yield pa.RecordBatch.from_arrays(
                [*(c.take(pa.array(begins)) for c in rows.columns[:5]),
                 pa.array([None if s else _bitmap(x).tobytes() for s, x in zip(listed, own, strict=True)], pa.binary()),
                 pa.array([x.astype(np.uint32).tobytes() if s else None for s, x in zip(listed, own, strict=True)], pa.binary())],
                names=[*keys, "p", "bitmap", "ids"])

    return arrow_rows(terms, *keys, "p", "id").mapInArrow(tidy(work), "lang string, block long, source string, n long, p long, bitmap binary, ids binary")


def _with_last(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, pa.RecordBatch]]:
    before = None
    for batch in batches:
        if before is not None:
            yield False, before
        before = batch
    if before is not None:
        yield True, before


def _members(bitmap: bytes | None, ids: bytes | None) -> np.ndarray:
    if ids is not None:
        return np.frombuffer(ids, np.uint32).astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(bitmap, np.uint8), bitorder="little"))


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def joint_sums(size: int, zero: np.ndarray, levels: list[tuple[int, int, np.ndarray]]) -> np.ndarray:
    """[g, h]: f of group g against group h, summed over a block's terms.

    ``zero``: each group's p of a term that it lacks; ``levels``: (group, p, ids).  Cells of two bitmaps are counted by AND and
    popcount, a group's missing terms being the complement of its levels; terms in a small level of either group are looked
    up.
    """
    groups, width = len(zero), (size + 63) // 64
    share_of = np.repeat(zero[:, None], size, axis=1)  # p by group and term
    small = np.zeros((groups, size), bool)
    rows, row_p, row_group = [], [], []
    absent = np.repeat(_bitmap(np.arange(size))[None, :], groups, axis=0)
    for g, p, ids in levels:
        share_of[g, ids] = p
        bits = _bitmap(ids)
        absent[g, : len(bits)] &= ~bits
        if SPARSE * len(ids) < size:
            small[g, ids] = True
        else:
            rows.append(np.pad(bits, (0, width - len(bits))))
            row_p.append(p)
            row_group.append(g)
    row_p, row_group = np.array([*zero, *row_p], np.int64), np.array([*range(groups), *row_group])
    order = np.argsort(row_group, kind="stable")
    bits = np.vstack([absent, *rows])[order]
    row_p, row_group = row_p[order], row_group[order]
    first = np.searchsorted(row_group, np.arange(groups + 1))
    out = np.zeros((groups, groups), np.int64)
    owner, of = np.nonzero(small)
    for g in range(groups - 1):
        mine, rest = slice(first[g], first[g + 1]), slice(first[g + 1], None)
        joint = np.stack([np.bitwise_count(bits[rest] & row).sum(axis=1, dtype=np.int64) for row in bits[mine]])
        p, q = row_p[mine][:, None], row_p[rest][None, :]
        cut = first[g + 1: groups] - first[g + 1]
        out[g, g + 1:] += np.add.reduceat((joint * _f(p, q)).sum(axis=0), cut)
        out[g + 1:, g] += np.add.reduceat((joint * _f(q, p)).sum(axis=0), cut)
        # terms in a small level of g, against all others; then those in a small level of another, but not of g
        at = np.flatnonzero(small[g])
        a, b = share_of[g, at][None, :], share_of[g + 1:, at]
        out[g, g + 1:] += _f(a, b).sum(axis=1)
        out[g + 1:, g] += _f(b, a).sum(axis=1)
        more = (owner > g) & ~small[g, of]
        h, t = owner[more], of[more]
        a, b = share_of[g, t], share_of[h, t]
        np.add.at(out[g], h, _f(a, b))
        np.add.at(out[:, g], h, _f(b, a))
    return out


def pair_sums(levels: DataFrame, groups: DataFrame, blocks: DataFrame) -> DataFrame:
    """(lang, source, item, value): f summed over the terms of each block, for every two groups of a language.

    A task holds one block: terms times groups, about ``CELLS``.
    """
    heads = blocks.join(groups, "lang").select("lang", "block", "source", F.lit(0).cast("long").alias("n"), share(F.lit(0), F.col("total"), F.col("terms")).alias("p"),
                                               F.lit(None).cast("binary").alias("bitmap"), F.lit(None).cast("binary").alias("ids"), "size")
    rows = heads.unionByName(levels.withColumn("size", F.lit(None).cast("long")))
    rows = rows.repartition("lang", "block").sortWithinPartitions("lang", "block", "source", "n")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sources, zero, found, size = None, [], [], [], 0

        def done() -> pa.RecordBatch:
            sums = joint_sums(size, np.array(zero, np.int64), found)
            a, b = np.nonzero(~np.eye(len(sources), dtype=bool))
            names = pa.array(sources, pa.string())
            return pa.RecordBatch.from_arrays([pa.array([now[0]] * len(a), pa.string()), names.take(pa.array(a)), names.take(pa.array(b)), pa.array(sums[a, b])],
                                              names=["lang", "source", "item", "value"])

        for batch in batches:
            for lang, block, source, n, p, bitmap, ids, own_size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (lang, block) != now:
                    if now is not None:
                        yield done()
                    now, sources, zero, found = (lang, block), [], [], []
                if own_size is not None:  # a group's head comes before its levels
                    sources.append(source)
                    zero.append(p)
                    size = own_size
                else:
                    found.append((len(sources) - 1, p, _members(bitmap, ids)))
        if now is not None:
            yield done()

    found = arrow_rows(rows, "lang", "block", "source", "n", "p", "bitmap", "ids", "size").mapInArrow(tidy(work), "lang string, source string, item string, value long")
    return found.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source of a language is from its others, and what marks it.

    Part ``pair``: every other source of the language, by divergence; part ``term``: the ``top`` kept terms that a source uses more
    than its language does.  Null texts, languages and sources count as ''; rows are documents, whatever their ids, so repeated
    ones count again.  A group without terms has pairs, a language without kept terms pairs of 0.  An empty table gives no
    rows; other columns of ``docs``, whatever their names, are not read.
    """
    counts = kept(term_counts(docs, lang, source, text), "term-counts")
    of_term = Window.partitionBy("lang", "term")
    found = counts.select("lang", "source", "term", "n", F.sum("n").over(of_term).alias("lang_n"), F.sum("docs").over(of_term).alias("in_docs"),
                          (F.row_number().over(of_term.orderBy("source")) == 1).cast("long").alias("first"))
    found = found.where(F.col("in_docs") >= min_docs).withColumn("level", F.floor(F.log2("lang_n")).cast("long"))
    found = kept(found.drop("in_docs"), "kept-terms")

    totals = found.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = found.groupBy("lang").agg(F.sum("first").alias("terms"), F.sum("n").alias("lang_total"))
    groups = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(a) for c, a in ((lang, "lang"), (source, "source")))).distinct()
    groups = groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0)
    groups = kept(groups.withColumn("groups", F.count(F.lit(1)).over(Window.partitionBy("lang"))), "groups")

    # blocks: terms of like frequency, dealt by hash to parts of a bounded size
    sizes = found.groupBy("lang", "level").agg(F.sum("first").alias("size"))
    sizes = sizes.join(groups.select("lang", "groups").distinct(), "lang")
    sizes = kept(sizes.select("lang", "level", F.ceil(F.col("size") * F.col("groups") / CELLS).alias("parts")), "blocks")
    rows = found.join(groups, ["lang", "source"]).join(sizes, ["lang", "level"])
    block = (F.col("level") * F.lit(1 << 40) + F.pmod(F.xxhash64("term"), F.col("parts"))).alias("block")
    rows = rows.select("lang", "source", "term", "n", "first", share(F.col("n"), F.col("total"), F.col("terms")).alias("p"),
                       share(F.col("lang_n"), F.col("lang_total"), F.col("terms")).alias("q"), block)
    rows = rows.withColumn("id", F.dense_rank().over(Window.partitionBy("lang", "block").orderBy("term")).cast("long") - 1)
    rows = kept(rows, "audit-terms")
    levels = kept(levels_of(rows.repartition("lang", "block").sortWithinPartitions("lang", "block", "source", "n", "id")), "levels")
    blocks = rows.groupBy("lang", "block").agg(F.sum("first").alias("size"))

    others = groups.select("lang", "source").join(groups.select("lang", F.col("source").alias("item")), "lang").where("source != item")
    pairs = others.join(pair_sums(levels, groups, blocks), ["lang", "source", "item"], "left").na.fill(0, ["value"])
    marks = rows.where("p > q").select("lang", "source", F.col("term").alias("item"), divergence(F.col("p"), F.col("q")).alias("value"))
    by_value = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).alias("rank")
    out = ["lang", "source", "part", "item", "value", "rank"]
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", by_value).select(*out)
    marks = marks.select("lang", "source", F.lit("term").alias("part"), "item", "value", by_value).where(F.col("rank") <= top).select(*out)
    return pairs.unionByName(marks)
