"""Fill-in-the-middle transformation (operator 12): a pyarrow.compute pipeline per batch.

A text's units are runs of non-space with the white space before them, and white space at its end.  Per batch they are
split into list arrays, flattened with their parents' indices, given ordinals, filtered by the role that a document's
two cuts give them, rebuilt into lists, and joined to pieces and outputs.  Nothing is shuffled, and no Python code sees
a single text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rotorwatch.llm.common import SPACE, arrow_rows, tidy
from rotorwatch.llm.pretokens import text_slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 42
RATE, SPM_RATE = 50, 80  # per cent of texts that are transformed, and of these that put the suffix first
_BORDER = b"\xff"  # no byte of UTF-8 text


def draws(doc_id: str | Column, seed: int = SEED) -> list[Column]:
    """Four unsigned 32-bit numbers of a document: the first digits of the sha256 of ``seed:doc_id`` (null id: nothing after
    the colon)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce((F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def units(texts: pa.Array) -> pa.Array:
    """List array of each text's units, in order."""
    marked = pc.replace_substring_regex(texts.cast(pa.large_binary()), f"([^{SPACE}])([{SPACE}])".encode(), rb"\1" + _BORDER + rb"\2")
    split = pc.split_pattern(marked, _BORDER)
    # an empty text is split into one empty unit, but has none
    flat, parents = pc.list_flatten(split), pc.list_parent_indices(split)
    some = pc.greater(pc.binary_length(flat), 0)
    return _lists(flat.filter(some), np.bincount(parents.filter(some).to_numpy(), minlength=len(texts)))


def _lists(values: pa.Array, lengths: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)), values)


def pieces(texts: pa.Array, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, list[pa.Array]]:
    """(units per text, [prefix, middle, suffix]); the cuts are ``first`` and ``last`` modulo the units plus one, in order."""
    split = units(texts)
    n = pc.list_value_length(split).to_numpy()
    one, two = first % (n + 1), last % (n + 1)
    begin, end = np.minimum(one, two), np.maximum(one, two)
    flat, parents = pc.list_flatten(split), pc.list_parent_indices(split).to_numpy()
    ordinal = np.arange(len(flat)) - (np.cumsum(n) - n)[parents]
    role = (ordinal >= begin[parents]).astype(np.int8) + (ordinal >= end[parents])
    lengths = (begin, end - begin, n - end)
    return n, [pc.binary_join(_lists(flat.filter(pa.array(role == k)), lengths[k]), pa.scalar(b"", pa.large_binary())) for k in range(3)]


def transform(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rate: int = RATE, spm_rate: int = SPM_RATE, seed: int = SEED,
              sentinels: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> DataFrame:
    """(doc_id, n, form, output, prefix_chars, middle_chars), a row per row of ``docs``.

    ``n`` counts a text's units.  ``form`` is ``plain`` (output is the text) for empty texts, for those that hold a sentinel,
    and for all but ``rate`` per cent; else ``spm`` (suffix, prefix, middle) for ``spm_rate`` per cent, or ``psm``.  Null
    texts count as empty; draws depend on the id alone, so rows with equal ids, or null ones, are cut by the same draws.  Texts of
    any length are taken whole; other columns of ``docs``, whatever their names, are not read.
    """
    prefix, suffix, middle = (s.encode() for s in sentinels)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in text_slices(batch.column(1)):
                ids, *h = (batch.column(c).slice(at, len(texts)) for c in (0, 2, 3, 4, 5))
                h = [np.asarray(x) for x in h]
                raw = texts.cast(pa.large_binary())
                n, cut = pieces(texts, h[0], h[1])
                plain = (n == 0) | (h[2] % 100 >= rate)
                for s in (prefix, suffix, middle):
                    plain |= pc.match_substring(raw, s).to_numpy(zero_copy_only=False)
                spm = pa.array(~plain & (h[3] % 100 < spm_rate))
                joined = [pc.binary_join_element_wise(*(x for name, piece in order for x in (pa.scalar(name, pa.large_binary()), piece)), pa.scalar(b"", pa.large_binary()))
                          for order in (((suffix, cut[2]), (prefix, cut[0]), (middle, cut[1])), ((prefix, cut[0]), (suffix, cut[2]), (middle, cut[1])))]
                plain = pa.array(plain)
                out = pc.if_else(plain, raw, pc.if_else(spm, *joined))
                form = pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm"))
                chars = [pc.if_else(plain, pa.scalar(None, pa.int64()), pc.utf8_length(c.cast(pa.large_string())).cast(pa.int64())) for c in cut[:2]]
                yield pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), form, out.cast(pa.large_string()).cast(pa.string()), *chars], names=names)

    names = [doc_id, "n", "form", "output", "prefix_chars", "middle_chars"]
    out = T.StructType([docs.schema[doc_id], T.StructField("n", T.LongType()), T.StructField("form", T.StringType()), T.StructField("output", T.StringType()),
                        T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType())])
    return arrow_rows(docs, doc_id, text, *draws(doc_id, seed)).mapInArrow(tidy(work), out)


def restored(output: str | Column = "output", form: str | Column = "form", sentinels: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> Column:
    """The text again, from output and form.  Transformed texts hold no sentinel, so an output has just three, and a ``<``
    that opens one is nowhere inside another: splitting there is exact."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    part = F.split(output, "|".join(f"\\Q{s}\\E" for s in sentinels), -1)
    return F.when(form == "spm", F.concat(part[2], part[3], part[1])).when(form == "psm", F.concat(part[1], part[3], part[2])).otherwise(output)
