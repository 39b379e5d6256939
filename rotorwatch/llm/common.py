"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rotorwatch.config import scratch_path

SPACE = r"\x20\x09-\x0D"  # the white space that ends a word, as a character class
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def tokenizer_file(name: str) -> str:
    """Place of a public tokenizer file; executors have the same installation."""
    import public_tokenizers

    return public_tokenizers.path(name)


BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def arrow_rows(df: DataFrame, *columns: Column | str) -> DataFrame:
    """``df``'s ``columns``, about to be handed to Python: batches go by bytes, not only by rows, so that long texts do not
    add up.  A session's own setting stays; only Spark's default of 64 MB is lowered, to 8 MB."""
    spark = df.sparkSession
    if spark.conf.get(BATCH).rstrip("bB") == str(64 << 20):
        spark.conf.set(BATCH, str(8 << 20))
    return df.select(*columns)


def tidy(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``work`` for ``mapInArrow``, giving memory back when a task ends: workers live on, and what a task's closures held in
    cycles would else stay until a full garbage collection happens to run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # where the C library has it
            ctypes.CDLL(None).malloc_trim(0)

    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def kept(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """``df`` as a table in the shared folder, read again: later steps neither repeat its work nor need its executors.
    ``compression``: of its files, the session's own if none."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def range_kept(df: DataFrame, name: str, order: Sequence[Column], carry: Sequence[str]) -> DataFrame:
    """``df``'s ``carry`` columns range-partitioned and sorted by ``order``, with ``_part`` (rising with the order) and
    ``_row`` (rising inside a part), written: what prefix sums over a global order start from."""
    parts = df.repartitionByRange(*order).sortWithinPartitions(*order)
    parts = parts.select(*carry, F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_row"))
    return kept(parts, name)


def running_sum(parts: DataFrame, value: str, within: Sequence[str], out: str) -> DataFrame:
    """``parts`` (of :func:`range_kept`, ordered by ``within`` first) with ``out``: the sum of ``value`` over the rows of
    the same ``within`` values before this one.  Sums by part come first, so no task sees more than a part's rows or
    one row per part."""
    names = [f"_in{k}" for k in range(len(within))]
    sums = parts.groupBy(*within, "_part").agg(F.sum(value).alias("_sum"))
    sums = sums.select(*(F.col(c).alias(n) for c, n in zip(within, names, strict=True)), F.col("_part").alias("_of"), "_sum")
    ahead = Window.partitionBy(*names).orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*names, "_of", F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_ahead"))
    inside = Window.partitionBy("_part", *within).orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    rows = parts.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    same = F.col("_part") == F.col("_of")
    for c, n in zip(within, names, strict=True):
        same &= F.col(c).eqNullSafe(F.col(n))
    return rows.join(sums, same, "left").select(*parts.columns, (F.col("_ahead") + F.col("_inside")).alias(out))
