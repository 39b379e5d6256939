"""Token-id files: frequency-ranked ids in byte-aligned variable-length coding (operator 8).

File format: a Parquet table of blocks in ascending ``doc_id`` order (by ``part``, then ``block``).  A block holds whole
documents, one at least: how many tokens lie ahead of it in its part, the documents' ids and lengths in tokens, and
their token ids.  A token id is replaced by its rank
by frequency in the corpus (rank 0 is the commonest), and a rank takes 1 to 4 little-endian bytes in ``data``; the
byte counts less one stand apart in ``control``, two bits each, four to a byte, the lowest bits first.  The ranks' ids
are one more table beside the blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from rotorwatch.config import scratch_path
from rotorwatch.llm import pretokens
from rotorwatch.llm.common import arrow_rows, kept, tidy

BLOCK_TOKENS = 1 << 18

_LENGTHS = np.stack([(np.arange(256) >> s & 3) + 1 for s in (0, 2, 4, 6)], axis=1).astype(np.uint8)  # by control byte


def pack_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """(control, data) of unsigned 32-bit values."""
    ranks = ranks.astype("<u4")
    extra = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    codes = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    codes[: len(ranks)] = extra
    codes = codes.reshape(-1, 4)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    cells = ranks.view(np.uint8).reshape(-1, 4)
    return control.astype(np.uint8).tobytes(), cells[np.arange(4) <= extra[:, None]].tobytes()


def unpack_ranks(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` values of :func:`pack_ranks`: byte counts by table lookup, then one gather per byte place."""
    length = _LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    at = np.cumsum(length, dtype=np.int64) - length
    raw = np.frombuffer(data, np.uint8)
    out = raw[at].astype(np.uint32)
    for place in (1, 2, 3):
        has = np.flatnonzero(length > place)
        if not len(has):
            break
        out[has] |= raw[at[has] + place].astype(np.uint32) << np.uint32(8 * place)
    return out


def _width(path: str, end_id: int) -> str:
    """Two bytes an id if all fit."""
    return "<u2" if max(pretokens.word_encoder(path).size, end_id + 1) <= 1 << 16 else "<u4"


def token_ids(docs: DataFrame, path: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens int, ids binary, counts): each row's ids and the end id, little-endian, 2 bytes each if all ids fit.

    One more row per task, and only it, has ``counts``: how often each id occurs in the task's texts (id, n), a row per id of the
    vocabulary at most; its ``n_tokens`` is null.
    """
    width = _width(path, end_id)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = pretokens.word_encoder(path, retain=True)
        total = np.zeros(max(encoder.size, end_id + 1), np.int64)
        kind = pa.list_(pa.struct([("id", pa.int32()), ("n", pa.int64())]))
        names, key = [doc_id, "n_tokens", "ids", "counts"], None
        for batch in batches:
            key = batch.column(0).type
            for first, part in pretokens.text_slices(batch.column(1)):
                ids, borders = encoder.ids(part)
                total += np.bincount(ids, minlength=len(total))
                total[end_id] += len(part)
                ids = np.insert(ids.astype(width), borders[1:], end_id)
                borders = borders + np.arange(len(borders))
                size = ids.dtype.itemsize
                cells = pa.Array.from_buffers(pa.binary(), len(part), [None, pa.py_buffer((borders * size).astype(np.int32)), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(part)), pa.array(np.diff(borders).astype(np.int32)), cells, pa.nulls(len(part), kind)], names=names)
        some = np.flatnonzero(total)
        if len(some):
            pairs = pa.StructArray.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["id", "n"])
            yield pa.RecordBatch.from_arrays([pa.nulls(1, key), pa.nulls(1, pa.int32()), pa.nulls(1, pa.binary()), pa.ListArray.from_arrays(pa.array([0, len(some)], pa.int32()), pairs)], names=names)

    counts = T.ArrayType(T.StructType([T.StructField("id", T.IntegerType()), T.StructField("n", T.LongType())]))
    out = T.StructType([docs.schema[doc_id], T.StructField("n_tokens", T.IntegerType()), T.StructField("ids", T.BinaryType()), T.StructField("counts", counts)])
    return arrow_rows(docs, doc_id, text).mapInArrow(tidy(encode), out)


def id_counts(tokens: DataFrame) -> DataFrame:
    """(id int, n long) over all rows of a written :func:`token_ids`, of which only the column ``counts`` is read."""
    return tokens.select(F.inline("counts")).groupBy("id").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class TokenFiles:
    blocks: str  # folder of the block table
    ranks: str  # folder of (rank, id)
    doc_id: str


def write_token_files(docs: DataFrame, path: str, end_id: int = 1, doc_id: str = "doc_id", text: str = "text", folder: str | None = None) -> TokenFiles:
    """Encode every whole text (null: empty) and write the blocks in ascending ``doc_id`` order, null ids first.

    Rows with equal ids stay, ordered by length and token ids, so reruns write the same bytes.  An empty table gives
    an empty block table.  Other columns of ``docs`` are not read.
    """
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "token-files")
    tokens = kept(token_ids(docs, path, end_id, doc_id, text), "token-ids")
    size, width = max(pretokens.word_encoder(path).size, end_id + 1), _width(path, end_id)
    counts = id_counts(tokens).orderBy(F.desc("n"), "id").collect()  # at most the vocabulary
    by_rank = np.array([r["id"] for r in counts], np.int64)
    rank_of = np.zeros(size, width)
    rank_of[by_rank] = np.arange(len(by_rank))
    ranks = spark.createDataFrame([(k, int(i)) for k, i in enumerate(by_rank)], "rank int, id int").coalesce(1)
    ranks.write.parquet(f"{folder}/ranks")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, ahead = TaskContext.get().partitionId(), 0, 0
        names, lengths, waiting, held = [], [], [], 0

        def close() -> pa.RecordBatch:
            control, data = pack_ranks(np.concatenate(waiting))
            cells = [[part], [block], [ahead], [held], pa.array([pa.concat_arrays(names).to_pylist()], pa.list_(kind)), [np.concatenate(lengths)], [control], [data]]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), None, pa.list_(pa.int32()), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([c if t is None else pa.array(c, t) for c, t in zip(cells, types, strict=True)], names=["part", "block", "ahead", "n_tokens", "doc_ids", "lengths", "control", "data"])

        for batch in batches:
            kind = batch.column(0).type
            sizes, cells = batch.column(1).to_numpy(), batch.column(2)
            borders = np.frombuffer(cells.buffers()[1], np.int32)[cells.offset: cells.offset + len(cells) + 1]
            ranked = rank_of[np.frombuffer(cells.buffers()[2], np.uint8)[borders[0]: borders[-1]].view(width)] if len(cells) else np.zeros(0, width)
            ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
            k = 0
            while k < len(sizes):
                # as many documents as still fit, or one whose block is its own
                to = int(np.searchsorted(ends, ends[k] + BLOCK_TOKENS - held, "right")) - 1
                if to <= k and held:
                    yield close()
                    block, ahead, names, lengths, waiting, held = block + 1, ahead + held, [], [], [], 0
                    continue
                to = max(to, k + 1)
                names.append(batch.column(0).slice(k, to - k))
                lengths.append(sizes[k:to])
                waiting.append(ranked[ends[k]: ends[to]])
                held += int(ends[to] - ends[k])
                k = to
        if held:
            yield close()

    out = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("block", T.IntegerType()), T.StructField("ahead", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("doc_ids", T.ArrayType(docs.schema[doc_id].dataType)), T.StructField("lengths", T.ArrayType(T.IntegerType())), T.StructField("control", T.BinaryType()), T.StructField("data", T.BinaryType())])
    ordered = tokens.where("n_tokens IS NOT NULL").select(doc_id, "n_tokens", "ids").repartitionByRange(F.col(doc_id).asc_nulls_first(), "n_tokens", F.xxhash64("ids")).sortWithinPartitions(F.col(doc_id).asc_nulls_first(), "n_tokens", F.xxhash64("ids"), "ids")
    ordered.mapInArrow(tidy(blocks), out).write.parquet(f"{folder}/blocks")
    return TokenFiles(f"{folder}/blocks", f"{folder}/ranks", doc_id)


def read_token_files(spark: SparkSession, files: TokenFiles) -> DataFrame:
    """(doc_id, start, n_tokens, ids): the documents of the files; ``start`` counts the ids of all documents before.

    ``ids`` are little-endian unsigned 32-bit integers.
    """
    blocks = spark.read.parquet(files.blocks)
    by_rank = np.array([r["id"] for r in spark.read.parquet(files.ranks).orderBy("rank").collect()], "<u4")  # at most the vocabulary
    kind = blocks.schema["doc_ids"].dataType.elementType
    # what the parts before hold: a row per file (some 12 bytes)
    sums = blocks.groupBy("part").agg(F.sum("n_tokens").alias("_sum"))
    before = sums.select(F.col("part").alias("_part"), F.coalesce(F.sum("_sum").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    joined = blocks.join(before, F.col("part") == F.col("_part")).select((F.col("_before") + F.col("ahead")).alias("start"), "doc_ids", "lengths", "control", "data")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                start, lengths = batch.column(0)[k].as_py(), batch.column(2)[k].values.to_numpy()
                ends = np.cumsum(lengths, dtype=np.int64)
                ids = by_rank[unpack_ranks(batch.column(3)[k].as_buffer(), batch.column(4)[k].as_buffer(), int(ends[-1]))]
                cells = pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(np.concatenate([[0], ends]) * 4), pa.py_buffer(ids)]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(1)[k].values, pa.array(start + ends - lengths), pa.array(lengths.astype(np.int64)), cells], names=[files.doc_id, "start", "n_tokens", "ids"])

    out = T.StructType([T.StructField(files.doc_id, kind), T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])
    return joined.mapInArrow(tidy(decode), out)


