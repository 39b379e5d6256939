"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy (operator 9).

A word is the bag of its character n-grams (bytes, with its borders) and itself, hashed to rows of an embedding table;
a window of words is the average of its words; two-class softmax weights turn it into a score, and a text's score is
that of its most toxic window, so a passage counts the same in a short text and a long one.  As all of that is linear,
scoring needs one number per n-gram: a text costs a sum over its distinct words' n-grams and a prefix sum.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rotorwatch.llm import pretokens
from rotorwatch.llm.common import arrow_rows, kept, tidy

GRAMS = (4, 5)
ROWS = 1 << 16  # of the embedding table
DIM = 8
WINDOW, STEP = 16, 8  # words
PER_CLASS = 2000  # toxic labelled texts that a model is fitted on, at most, and twice as many others
SAMPLE_BYTES = 96 << 20  # of all texts that a model is fitted on: a third for toxic ones, the rest for others
ROUNDS = 80
STRIDE = 60.0  # of the first step, for the n-gram that moves most
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def subwords(vocabulary: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of all n-grams of all words one after the other, and each word's first (one entry more)."""
    words = vocabulary.cast(pa.large_binary())
    borders = np.frombuffer(words.buffers()[1], np.int64)[words.offset: words.offset + len(words) + 1]
    n = len(words)
    # each word between two border marks
    size = np.diff(borders) + 2
    ends = np.cumsum(size)
    starts = ends - size
    data = np.full(int(ends[-1]) if n else 0, 3, np.uint64)
    inner = np.ones(len(data), bool)
    inner[starts] = inner[ends - 1] = False
    data[starts] = 2
    if n:
        data[inner] = np.frombuffer(words.buffers()[2], np.uint8)[borders[0]: borders[-1]] if words.buffers()[2] is not None else 0
    of = np.repeat(np.arange(n), size)
    left = (np.repeat(ends, size) - np.arange(len(data))).astype(np.int64)
    rows, owner = [], []
    rolling = data + np.uint64(7)
    for k in range(2, max(GRAMS) + 1):
        nxt = np.zeros_like(rolling)
        nxt[: -(k - 1)] = data[k - 1:]
        rolling = (rolling * _PRIME + nxt + np.uint64(k)) * np.uint64(0xD6E8FEB86659FD93)
        rolling ^= rolling >> np.uint64(29)
        if k in GRAMS:
            has = np.flatnonzero(left >= k)
            rows.append((rolling[has] >> np.uint64(13)) % np.uint64(ROWS))
            owner.append(of[has])
    place = np.arange(len(data)) - np.repeat(starts, size)
    with np.errstate(over="ignore"):
        power = _PRIME ** (place.astype(np.uint64) + np.uint64(1))
        whole = np.add.reduceat((data + np.uint64(11)) * power, starts) if n else np.zeros(0, np.uint64)
    rows.append((whole >> np.uint64(17)) % np.uint64(ROWS))
    owner.append(np.arange(n))
    rows, owner = np.concatenate(rows).astype(np.int32), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return rows[order], np.searchsorted(owner[order], np.arange(n + 1))


def _sums(values: np.ndarray, borders: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values)])
    return total[borders[1:]] - total[borders[:-1]]


def windows(firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begin, end, text) of all windows of texts with borders ``firsts``; a text has one at least, maybe empty."""
    size = np.diff(firsts)
    n = 1 + np.maximum(0, -(-(size - WINDOW) // STEP))
    text = np.repeat(np.arange(len(size)), n)
    begin = firsts[text] + (np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)) * STEP
    return begin, np.minimum(begin + WINDOW, firsts[text + 1]), text


@dataclass(frozen=True)
class Model:
    grams: np.ndarray  # what each table row adds to the log odds: embedding times weights
    bias: float

    def logits(self, texts: pa.Array) -> np.ndarray:
        """Log odds of each text of a slice (large_string, no nulls)."""
        vocabulary, at, firsts = pretokens.words(texts)
        if not len(at):
            return np.full(len(texts), self.bias)
        rows, borders = subwords(vocabulary)
        word = _sums(self.grams[rows], borders) / np.diff(borders)
        return self.bias + _best(word[at], firsts)[0]


def _best(values: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each text's highest window average, and that window's borders."""
    begin, end, text = windows(firsts)
    total = np.concatenate([[0.0], np.cumsum(values)])
    mean = (total[end] - total[begin]) / np.maximum(1, end - begin)
    opens = np.searchsorted(text, np.arange(len(firsts) - 1))
    top = np.maximum.reduceat(mean, opens)
    hit = np.flatnonzero(mean == top[text])
    hit = hit[np.searchsorted(text[hit], np.arange(len(opens)))]
    return top, begin[hit], end[hit]


def _blocks(texts: pa.Array) -> tuple[pa.Array, list[tuple[np.ndarray, np.ndarray]]]:
    """Distinct words of all texts, and for each slice of the texts its words' places among them and its texts' firsts: what
    :func:`pretokens.words` gives, with memory by the slice."""
    parts = [pretokens.words(part) for _, part in pretokens.text_slices(texts)]
    cells = pa.chunked_array([p[0] for p in parts]).dictionary_encode().combine_chunks()
    cells = cells.chunk(0) if isinstance(cells, pa.ChunkedArray) else cells
    to, blocks, begin = cells.indices.to_numpy(), [], 0
    for vocabulary, at, firsts in parts:
        blocks.append((to[begin: begin + len(vocabulary)][at], firsts))
        begin += len(vocabulary)
    return cells.dictionary, blocks


def fit(texts: list[str] | pa.Array, labels: list[int], seed: int = 11) -> Model:
    """Train embeddings and softmax weights jointly on the texts' highest windows, classes weighted equally.

    Gradient steps have a set length and keep the gradient's shape: n-grams that tell the classes apart in many texts
    move far, those of a few texts hardly.  Without texts of both classes the model gives every text the only label,
    0 without any text.
    """
    y = np.asarray(labels, float)
    if not len(y) or y.min() == y.max():
        return Model(np.zeros(ROWS), -20.0 if not len(y) or y[0] == 0 else 20.0)
    vocabulary, blocks = _blocks(pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts)
    rows, borders = subwords(vocabulary)
    per_word = np.diff(borders)
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 0.01, (ROWS, DIM))
    weight, bias = rng.normal(0, 1, (DIM, 2)) / np.sqrt(2 * DIM), np.zeros(2)
    balance = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    for step in range(ROUNDS):
        apart = weight[:, 1] - weight[:, 0]
        word = _sums((table @ apart)[rows], borders) / per_word
        top, size, hit = [], [], []
        for at, firsts in blocks:
            best, begin, end = _best(word[at], firsts)
            long = end - begin
            top.append(best)
            size.append(long)
            hit.append(at[np.repeat(begin - (np.cumsum(long) - long), long) + np.arange(long.sum())])
        top, size, hit = np.concatenate(top), np.concatenate(size), np.concatenate(hit)
        odds = top + bias[1] - bias[0]
        error = (1 / (1 + np.exp(-np.clip(odds, -40, 40))) - y) * balance  # of the toxic class; the other's is its negative
        # each window's error to its words, each word's to its n-grams
        share = np.bincount(hit, np.repeat(error / np.maximum(1, size), size), len(vocabulary))
        each = np.bincount(rows, np.repeat(share / per_word, per_word), ROWS)
        pull = table.T @ each
        rate = 1 - step / ROUNDS
        table -= rate * STRIDE * np.outer(each / (np.abs(each).max() + 1e-30), apart)
        weight -= rate * 0.02 * np.stack([-pull, pull], axis=1) / (np.abs(pull).max() + 1e-30)
        bias -= rate * 1.0 * np.array([-error.sum(), error.sum()])
    return Model(table @ (weight[:, 1] - weight[:, 0]), float(bias[1] - bias[0]))


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", per_class: int = PER_CLASS, sample_bytes: int = SAMPLE_BYTES) -> Model:
    """Fit on at most ``per_class`` toxic texts and twice as many others, of any length: those first by a hash of their ids among
    documents that are labelled and not held out.  ``sample_bytes`` bounds them together, a third of it for toxic texts: of
    each class, texts are taken until its share is full, the last one as a whole, so each class has one at least.  One
    task fits, on no more than those texts; the driver gets the model alone.  Null labels and ids are left out; a
    document labelled more than once is toxic if any label says so; of rows with one id, that with the least hash of its
    text counts."""
    marked = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("_id")).agg(F.max(label).cast("int").alias("_y")).where(~held_out(F.col("_id")))
    texts = docs.select(F.col(doc_id).alias("_doc"), F.coalesce(F.col(text), F.lit("")).alias("_text")).where("_doc IS NOT NULL")
    # labels without a document take no place in the sample
    texts = texts.withColumn("_hash", F.xxhash64("_text"))
    sizes = texts.groupBy("_doc").agg(F.min(F.struct("_hash", F.octet_length("_text").alias("_bytes"))).alias("_one")).select("_doc", "_one.*")
    sizes = kept(sizes.join(marked, F.col("_doc") == F.col("_id")).select("_doc", "_hash", "_y", "_bytes"), "toxicity-sizes")
    most = {0: 2 * per_class, 1: per_class}
    chosen = []
    for y, n in most.items():
        left = max(1, sample_bytes * n // (3 * per_class))
        for r in sizes.where(F.col("_y") == y).orderBy(F.xxhash64("_doc"), "_doc").limit(n).collect():
            if left > 0:
                chosen.append((r["_doc"], r["_hash"], y))
                left -= r["_bytes"]
    if not chosen:
        return fit([], [])
    small = F.broadcast(docs.sparkSession.createDataFrame(chosen, T.StructType([T.StructField("_id", docs.schema[doc_id].dataType), T.StructField("_least", T.LongType()), T.StructField("_y", T.IntegerType())])))
    found = texts.join(small, (F.col("_doc") == F.col("_id")) & (F.col("_hash") == F.col("_least")))
    # equal rows become one before they leave their tasks
    found = kept(found.groupBy("_doc", "_y").agg(F.min("_text").alias("_text")), "toxicity-sample")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, marks = [], []
        for batch in batches:
            marks += batch.column(0).to_pylist()
            texts.append(batch.column(1).cast(pa.large_string()))
        model = fit(pa.concat_arrays(texts), marks) if texts else fit([], [])
        yield pa.RecordBatch.from_arrays([pa.array([model.grams.tobytes()]), pa.array([model.bias])], names=["grams", "bias"])

    ordered = found.repartition(1).sortWithinPartitions(F.xxhash64("_doc"), "_doc")
    rows = arrow_rows(ordered, "_y", "_text").mapInArrow(tidy(work), "grams binary, bias double").collect()
    return Model(np.frombuffer(bytes(rows[0]["grams"])), rows[0]["bias"]) if rows else fit([], [])


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, ``carry`` columns, score), a row per row of ``docs``: the probability of toxicity by the whole text.

    A null or empty text, or one of white space, has the score of no words; nothing but the text is an input.
    """
    names = list(dict.fromkeys([doc_id, *carry]))
    columns = names if text in names else [*names, text]
    place = columns.index(text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, part in pretokens.text_slices(batch.column(place)):
                values = 1 / (1 + np.exp(-np.clip(model.logits(part), -40, 40)))
                yield pa.RecordBatch.from_arrays([*(c.slice(first, len(part)) for c in batch.columns[: len(names)]), pa.array(values)], names=[*names, "score"])

    out = T.StructType([*(docs.schema[c] for c in names), T.StructField("score", T.DoubleType())])
    return arrow_rows(docs, *columns).mapInArrow(tidy(work), out)
