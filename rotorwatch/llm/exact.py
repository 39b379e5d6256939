"""Exact dedup by content sort (operator 6), in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rotorwatch.llm.common import CAPITALS, SMALL, kept

HEAD = 24  # characters of a normalised text that lead its sort key


def normalised(text: Column) -> Column:
    """Null as empty, and A-Z (no other letter) in lower case."""
    text = F.coalesce(text, F.lit(""))
    only_ascii = F.length(text) == F.octet_length(text)  # then the faster function does the same
    return F.when(only_ascii, F.lower(text)).otherwise(F.translate(text, CAPITALS, SMALL))


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: str = "smallest") -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), a row per row of ``docs``, over whole normalised texts.

    Sampled splitters range-partition (the text's head, its hash, a salt from the id); an external sort by the whole
    text then places equals side by side, and each row is compared in full with its neighbour.  The salt deals a
    group of equals to many partitions; the runs found there meet again by their texts' SHA-256, one row per run.

    ``keep``: whether the smallest or the largest id of equals stays.  Null ids count only where a group has no other.
    Of rows with the same id and text one is kept.  An empty table gives no rows; a null or empty text is a text like
    any other; other columns of ``docs`` are not read.
    """
    best = {"smallest": F.min, "largest": F.max}[keep]
    salts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(F.col(doc_id).alias("_id"), normalised(F.col(text)).alias("_text"))
    rows = rows.select("*", F.left("_text", F.lit(HEAD)).alias("_head"), F.xxhash64("_text").alias("_hash"), F.pmod(F.xxhash64(F.lit(1), "_id"), F.lit(salts)).cast("int").alias("_salt"))
    # the window's keys are those of the range partitioning: no second shuffle of texts
    near = Window.partitionBy("_head", "_hash", "_salt").orderBy("_text", "_id")
    rows = rows.repartitionByRange("_head", "_hash", "_salt").select(
        "_id", "_text", "_head", "_hash", "_salt", F.lag("_text").over(near).alias("_before"), F.lag(F.struct("_id")).over(near).alias("_id_before"))
    first = ~F.col("_text").eqNullSafe(F.col("_before"))
    rows = rows.withColumn("_sha", F.when(first, F.sha2("_text", 256)))
    runs = rows.select("_id", "_salt", F.last("_sha", ignorenulls=True).over(near).alias("_sha"), (~first & F.struct("_id").eqNullSafe(F.col("_id_before"))).alias("_again"))
    runs = kept(runs, "content-sort")
    by_run = runs.groupBy("_sha", "_salt").agg(best("_id").alias("_best"), F.count(F.lit(1)).alias("_n"))
    groups = by_run.groupBy("_sha").agg(best("_best").alias("keep_id"), F.sum("_n").alias("group_size"))
    decided = by_run.select(F.col("_sha").alias("_s"), F.col("_salt").alias("_k")).join(groups, F.col("_s") == F.col("_sha")).select("_s", "_k", "keep_id", "group_size")
    joined = runs.join(decided, (F.col("_sha") == F.col("_s")) & (F.col("_salt") == F.col("_k")))
    stays = F.col("_id").eqNullSafe(F.col("keep_id")) & ~F.col("_again")
    return joined.select(F.col("_id").alias(doc_id), "keep_id", "group_size", stays.alias("kept"), F.col("_sha").alias("text_sha256"))
