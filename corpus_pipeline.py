"""The training-data pipeline: toxic documents out, exact and near copies out, sources mixed to targets, sequences packed.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``docs``.  Rows are
told apart by their id and a hash of their text, so repeated ids do no harm.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rotorwatch.llm import exact, mixing, nearcopies, packing, toxicity
from rotorwatch.llm.common import kept, table, tokenizer_file
from rotorwatch.llm.queries import END_ID, WORDS, quality_weight

ROW = "_row"


READ = ("doc_id", "text", "source")  # the columns that stages know


def _own_names(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """``stage`` with names of their own for all other columns while it runs, so that they clash with none of its helpers."""

    @functools.wraps(stage)
    def renamed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        inside = docs.toDF(*(c if c in READ else f"_extra{k}" for k, c in enumerate(docs.columns)))
        return stage(spark, inside, sf_dir).toDF(*docs.columns)

    return renamed


def _with_row(docs: DataFrame) -> DataFrame:
    return docs.withColumn(ROW, F.struct("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("mark")))


@_own_names
def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose whole text scores below one half; the model learns from this stage's documents that are labelled."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, carry=tuple(docs.columns)).where(F.col("score") < 0.5).select(*docs.columns)


@_own_names
def exact_copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts but for A-Z, that with the smallest id; of rows with equal id and text, one."""
    rows = _with_row(docs)
    stay = exact.exact_duplicates(rows, ROW).where("kept").select(F.col(ROW).alias("_stays"))
    rows = rows.join(stay, F.col(ROW).eqNullSafe(F.col("_stays")), "left_semi")
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(ROW).orderBy(ROW))).where("_n = 1").select(*docs.columns)


@_own_names
def near_copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group linked by five-word shingles and a similarity of 0.8 or more."""
    rows = _with_row(docs)
    stay = nearcopies.near_duplicates(rows, ROW).where("kept").select(F.col(ROW).alias("_stays"))
    return rows.join(stay, F.col(ROW).eqNullSafe(F.col("_stays")), "left_semi").select(*docs.columns)


@_own_names
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: its row repeated, or left out where its source is over its target."""
    rows = _with_row(docs)
    sized = rows.select("doc_id", ROW, "source", mixing.words(F.col("text")).alias("size"))
    takes = mixing.mix(quality_weight(sized, table(spark, sf_dir, "labels")), doc_id=ROW, size="size", quality=F.col("_quality"))
    # rows with equal id and text share what they are taken
    takes = takes.groupBy(F.col(ROW).alias("_taken")).agg(F.sum("times").alias("_times"), F.count(F.lit(1)).alias("_rows")).where("_times > 0")
    rows = rows.join(takes, F.col(ROW).eqNullSafe(F.col("_taken")))
    place = F.row_number().over(Window.partitionBy(ROW).orderBy(ROW))
    rows = rows.withColumn("_n", place).withColumn("_n", F.floor(F.col("_times") / F.col("_rows")) + (F.col("_n") <= F.col("_times") % F.col("_rows")).cast("int"))
    return rows.where("_n > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int")))).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 token ids: a row per piece, with its ids."""
    return packing.pack(docs, tokenizer_file(WORDS), END_ID)


STAGES = [
    ("toxicity", toxic_out),
    ("exact dedup", exact_copies_out),
    ("near dedup", near_copies_out),
    ("mixing", mixed),
    ("packing", packed),
]

#: The model's scores, near-duplicate search and mixing keys are beyond SQL: tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each reading what the one before has written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
