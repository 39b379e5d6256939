"""Mixing sources to target weights (operator 2), in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rotorwatch.llm.common import SPACE, kept, range_kept, running_sum

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2


def words(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size, target) for (source, source_size), a row per source: ``weights`` go round by code point, null
    last; targets share ``share`` of all sizes by weight, stop at ``most`` times their source's size, and what is over
    is shared again by weight until none is above.

    The shared level is the largest of the levels that result if the first k sources, by size over weight, are full.
    The windows run over the table of sources, which is of the size of the mix's configuration.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.pmod(rank, F.lit(len(weights))) + 1).cast("int"))
    rows = sources.select("source", "source_size", weight.alias("_w"), (F.col("source_size") * F.lit(most)).cast("double").alias("_cap"))
    all_ = Window.partitionBy()
    by_need = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("source_size").over(all_) * F.lit(float(share))
    full, taken = (F.coalesce(F.sum(c).over(by_need), F.lit(0.0)) for c in ("_cap", "_w"))
    rows = rows.select("*", ((total - full) / (F.sum("_w").over(all_) - taken)).alias("_level"))
    rows = rows.select("*", F.max("_level").over(all_).alias("_top"))
    return rows.select("source", "source_size", F.least(F.col("_w") * F.col("_top"), F.col("_cap")).alias("target"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", quality: Column | None = None, size: str | None = None, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: int = MOST, seed: int = 7) -> DataFrame:
    """(doc_id, source, size, source_size, target, times, taken), a row per row of ``docs``; ``taken`` = ``times`` x ``size``.

    Each source first gives as many whole epochs as its target holds.  For the rest, its documents are sorted by
    Efraimidis-Spirakis keys, -ln(u) / ``quality`` with u a hash of ``seed`` and id, and their sizes prefix-summed: a
    document is in if at least half of it lies within the rest, so a source misses its target by half a document at
    most.  (source, key) is range-partitioned, so a source of any size spreads over tasks, and prefix sums go by part.

    ``size``: a column that holds the sizes; else they are the texts' words.  ``quality``: weights, 1 where null or left out;
    documents whose weight is 0, negative or NaN come after all others of their source, in order of their ids.  Null sources are a source; null texts have size 0 and
    are taken 0 times beyond the epochs; rows with equal ids share a key and stay rows of their own; an empty table gives no rows.  Reruns
    give the same mix.  Other columns of ``docs`` matter only to ``quality``.
    """
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(doc_id)), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    weight = F.coalesce(quality.cast("double") if quality is not None else F.lit(1.0), F.lit(1.0))
    key = F.when((weight > 0) & ~F.isnan(weight), -F.log(u) / weight).otherwise(F.lit(float("inf")))
    sized = kept(docs.select(F.col(doc_id).alias("_id"), F.col(source).alias("source"), (F.col(size).cast("long") if size else words(F.col(text))).alias("size"), key.alias("_key")), "mix-sizes")
    order = [F.col("source").asc_nulls_last(), F.col("_key"), F.col("_id"), F.col("size")]
    parts = range_kept(sized, "mix-order", order, ["_id", "source", "size", "_key"])
    targets = source_targets(parts.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    targets = targets.withColumnRenamed("source", "_source")
    rows = running_sum(parts, "size", ["source"], "_before").join(targets, F.col("source").eqNullSafe(F.col("_source")))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("int")
    rest = F.col("target") - F.col("_epochs") * F.col("source_size")
    more = ((F.col("size") > 0) & (F.col("_before") + F.col("size") / 2 <= rest)).cast("int")
    rows = rows.withColumn("_epochs", epochs).withColumn("times", F.col("_epochs") + more)
    return rows.select(F.col("_id").alias(doc_id), "source", "size", "source_size", "target", "times", (F.col("times") * F.col("size")).alias("taken"))
