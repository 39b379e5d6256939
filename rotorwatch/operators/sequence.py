"""Per-key ordered windows computed bucket-parallel.

A ``Window.partitionBy(machine)`` over readings puts every reading of a
machine into one task; a machine holding a third of all rows would stall the
job.  Here rows are partitioned by (key, bucket) instead, and each bucket
receives copies of the ``n`` rows that precede it in key order (they may come
from several earlier buckets).  Row frames of up to ``n`` preceding rows then
give exactly the result of the per-key window.

Buckets are cut by rank (:func:`rank_buckets`): rows are range-partitioned by
(key, order) from sampled splitters, sorted, and cut into slices of a fixed
number of rows.  How the rows spread over time does not matter: a burst, or one
row with a wild clock, leaves every bucket at or under that number.

The sorted rows are written once, and all further steps read that table.  One
more shuffle brings them into (key, bucket) for the final frame, together with
the copies.  The copies come from the last ``n`` rows of every bucket, which a
partial WindowGroupLimit trims on the map side, and from a per-bucket count
table (one row per key and bucket).  Each bucket joins the tails of exactly
the preceding buckets that hold its ``n`` predecessors, so at most about
``2n`` rows are produced per bucket whatever the density.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rotorwatch.config import scratch_path, shared_dir

BUCKET = "_bucket"
CARRY = "_carry"


def rank_buckets(df: DataFrame, keys: list[str], order: list[str], rows_per_bucket: int,
                 out: str = "_rank_bucket") -> DataFrame:
    """``df`` as a written table sorted by (keys, order), with ``out``: a bucket
    number that rises with that order and is shared by at most
    ``rows_per_bucket`` rows."""
    if rows_per_bucket < 1:
        raise ValueError("rows_per_bucket must be >= 1")
    # part number and place in the part, as monotonically_increasing_id packs them
    place, part = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)), F.shiftright("_place", 33)
    rows = (df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
            .withColumn("_place", F.monotonically_increasing_id())
            .withColumn(out, F.shiftleft(part, 33) + F.floor(place / F.lit(rows_per_bucket)).cast("long"))
            .drop("_place"))
    path = scratch_path(df.sparkSession, "rank-buckets")
    rows.write.parquet(path)
    return df.sparkSession.read.schema(rows.schema).parquet(path)


def _buckets_needed(counts: Column, n: int) -> Column:
    """How many of the latest buckets in ``counts`` (row counts, oldest first)
    hold the last ``n`` rows; all of them when they hold fewer."""
    start = F.struct(F.lit(0).cast("long").alias("rows"), F.lit(0).alias("buckets"))

    def step(acc: Column, cnt: Column) -> Column:
        return F.when(acc["rows"] >= n, acc).otherwise(
            F.struct((acc["rows"] + cnt).alias("rows"), (acc["buckets"] + 1).alias("buckets")))

    return F.aggregate(F.reverse(counts), start, step)["buckets"]


def with_preceding(df: DataFrame, keys: list[str], order: list[str], bucket: str, n: int) -> DataFrame:
    """Rows of ``df`` plus, per (keys, bucket), copies of the ``n`` preceding rows.

    ``bucket`` is a column of ``df`` that increases with ``order`` (rows of a
    later bucket come strictly later).  Adds ``_bucket`` (bucket the row is
    evaluated in) and ``_carry`` (true for copies).  Evaluate with
    ``frame(keys, order)`` and keep rows with ``_carry`` false.
    """
    if n < 1:
        raise ValueError("n must be >= 1")
    # one row per (key, bucket): its rank (_ord), rows before it (_base), and
    # how many preceding buckets hold its n predecessors (_span; every bucket
    # has a row, so at most n).  Small and used twice: computed once into the
    # shared checkpoint folder.
    shared_dir(df.sparkSession)
    per_key = Window.partitionBy(*keys).orderBy(bucket)
    stats = (df.groupBy(*keys, bucket).agg(F.count(F.lit(1)).alias("_cnt"))
             .withColumn("_ord", F.row_number().over(per_key))
             .withColumn("_base", F.coalesce(F.sum("_cnt").over(per_key.rowsBetween(Window.unboundedPreceding, -1)),
                                             F.lit(0)))
             .withColumn("_span", _buckets_needed(F.collect_list("_cnt").over(per_key.rowsBetween(-n, -1)), n))
             .checkpoint(eager=True))

    # the last n rows of each bucket, with their position in the key (1-based)
    from_end = Window.partitionBy(*keys, bucket).orderBy(*[F.col(c).desc() for c in order])
    tails = (df.withColumn("_rd", F.row_number().over(from_end))
             .filter(F.col("_rd") <= n)
             .join(stats.select(*keys, bucket, "_ord", "_base", "_cnt"), [*keys, bucket])
             .withColumn("_pos", F.col("_base") + F.col("_cnt") - F.col("_rd") + 1))

    # each bucket asks for the tails of the _span buckets before it and keeps
    # the rows among its n predecessors
    targets = (stats.filter(F.col("_span") > 0)
               .select(*keys, F.col(bucket).alias("_tgt_bucket"), F.col("_base").alias("_tgt_base"),
                       F.explode(F.sequence(F.col("_ord") - F.col("_span"), F.col("_ord") - 1)).alias("_ord")))
    carried = (tails.join(targets, [*keys, "_ord"])
               .filter(F.col("_pos") > F.col("_tgt_base") - n)
               .select(*df.columns, F.col("_tgt_bucket").alias(BUCKET), F.lit(True).alias(CARRY)))
    own = df.select(*df.columns, F.col(bucket).alias(BUCKET), F.lit(False).alias(CARRY))
    # Spark accepts a partitioning on a subset of the clustering keys, which
    # could put a whole machine back into one task: pin (keys, bucket).
    return own.unionByName(carried).repartition(*keys, BUCKET)


def frame(keys: list[str], order: list[str]) -> Window:
    """Window over a :func:`with_preceding` result, in key order."""
    return Window.partitionBy(*keys, BUCKET).orderBy(*order)
