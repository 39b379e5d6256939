"""Connected components by alternating star contraction, in DataFrame functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rotorwatch.llm.common import kept


def components(edges: DataFrame) -> DataFrame:
    """(node, root): for each node of ``edges`` (columns a, b of one ordered type) that is not the smallest of its component, the
    smallest.  Each round every node hands its neighbours to the smallest of them, larger ones first, then smaller
    ones; after some log2(n) rounds all hang on the roots.  Rounds read tables that the ones before have written."""
    now = kept(edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    before = None
    while True:
        mark = now.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).collect()[0]
        if mark["n"] == 0 or (before is not None and tuple(mark) == before):
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = tuple(mark)
        # larger neighbours to the smallest of all neighbours and the node itself
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m")).select("w", F.least("w", "m").alias("m"))
        large = both.where("v > u").join(least, F.col("u") == F.col("w")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = kept(large, "links")
        # smaller neighbours, and the node itself, to the smallest of them
        least = large.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
        moved = large.join(least, F.col("u") == F.col("w")).where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = kept(moved.unionByName(least.select(F.col("w").alias("u"), F.col("m").alias("v"))).distinct(), "links")
