"""Token counts: map-side two-tier lookup (operator 7).

Tier one is a compact Arrow table of the most frequent pre-tokens and their token counts, made from a first pass over
all documents and sent with the tasks; tier two is a cache in each Python worker that the library fills on a miss.
Pre-tokens are never shuffled: only each slice's short list of its own most frequent ones is summed up.  The tiers
decide speed alone; counts always equal the library's.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rotorwatch.llm import pretokens
from rotorwatch.llm.common import arrow_rows, kept, tidy

TABLE_ENTRIES = 32_768  # size of tier one: a fixed bound of about 1 MB, however large the corpus is
SLICE_ENTRIES = 4_096  # what each slice of text puts forward


def frequent_pretokens(docs: DataFrame, text: str = "text", entries: int = TABLE_ENTRIES) -> DataFrame:
    """(pretoken binary, n long): the most frequent by what the slices put forward, down to a power of two in ``n`` that
    leaves ``entries`` of them at most, so that no more ever reach the driver."""

    def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, part in pretokens.text_slices(batch.column(0)):
                cells, _ = pretokens.segments(part, True, False)
                if cells is None:
                    continue
                n = np.bincount(cells.indices.to_numpy(), minlength=len(cells.dictionary))
                top = np.argpartition(-n, SLICE_ENTRIES)[:SLICE_ENTRIES] if len(n) > SLICE_ENTRIES else np.arange(len(n))
                yield pa.RecordBatch.from_arrays([cells.dictionary.take(pa.array(top)), pa.array(n[top])], names=["pretoken", "n"])

    slices = arrow_rows(docs, text).mapInArrow(tidy(forward), "pretoken binary, n long")
    found = kept(slices.groupBy("pretoken").agg(F.sum("n").alias("n")), "pretokens")
    level = F.floor(F.log2("n")).cast("int").alias("level")
    held, least = 0, None
    for r in found.groupBy(level).count().orderBy(F.desc("level")).collect():  # some 60 rows
        held += r["count"]
        if held > entries:
            break
        least = 1 << r["level"]
    return found.where(F.col("n") >= least) if least else found.limit(0)


def count_tokens(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens), a row per row of ``docs``, under the byte-level ``tokenizers`` file at ``path``.

    Null and empty texts have 0 bytes and 0 tokens; null ids and repeated rows stay as they are; other columns of
    ``docs``, whatever their names, are not read.  Texts of any length are counted whole.
    """
    rows = frequent_pretokens(docs, text).collect()  # at most TABLE_ENTRIES
    keys = [bytes(r["pretoken"]) for r in rows]
    encoder = pretokens.byte_encoder(path)
    place = encoder.cached(keys)
    lengths = (encoder.store.starts[place + 1] - encoder.store.starts[place]).astype(np.int32) if keys else np.zeros(0, np.int32)
    tier_one = pa.array(keys, pa.binary())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = pretokens.byte_encoder(path)
        for batch in batches:
            for first, part in pretokens.text_slices(batch.column(1)):
                _, borders = pretokens.flat(part)
                cells, firsts = pretokens.segments(part, encoder.attach_space, encoder.lower)
                tokens = np.zeros(len(part), np.int64)
                if cells is not None:
                    at = pc.index_in(cells.dictionary, value_set=tier_one)
                    each = np.zeros(len(cells.dictionary), np.int64)
                    hit = pc.is_valid(at).to_numpy(zero_copy_only=False)
                    each[hit] = lengths[at.drop_null().to_numpy()]
                    place = encoder.cached(cells.dictionary.filter(pa.array(~hit)).to_pylist())
                    each[~hit] = encoder.store.starts[place + 1] - encoder.store.starts[place]
                    tokens = np.diff(np.concatenate([[0], np.cumsum(each[cells.indices.to_numpy()])])[firsts])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(part)), pa.array(np.diff(borders)), pa.array(tokens)], names=[doc_id, "n_bytes", "n_tokens"])

    out = T.StructType([docs.schema[doc_id], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])
    return arrow_rows(docs, doc_id, text).mapInArrow(tidy(count), out)
