"""Join helpers: small sides are broadcast by their measured size."""

from __future__ import annotations

from pyspark.sql import DataFrame

from rotorwatch.config import scratch_path


def measured(dim: DataFrame) -> DataFrame:
    """``dim`` as a written table.

    Spark then plans with the table's size in bytes: a dimension under
    ``spark.sql.autoBroadcastJoinThreshold`` is broadcast from the start, and
    the large side is never shuffled; a larger one is joined by a shuffle that
    AQE splits where it is skewed.  Left as a plan, a dimension that is derived
    from large data has no size before it runs, and the large side would be
    shuffled before AQE could tell.
    """
    spark = dim.sparkSession
    path = scratch_path(spark, "dimension")
    dim.write.parquet(path)
    return spark.read.schema(dim.schema).parquet(path)
