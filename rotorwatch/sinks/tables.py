"""Keyed upsert and run log."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rotorwatch.config import drop_path, scratch_path
from rotorwatch.schemas import RUN_LOG
from rotorwatch.sources.raw import read_table


class DuplicateKeyError(ValueError):
    pass


def upsert(spark: SparkSession, path: str, incoming: DataFrame, keys: list[str], partition: str,
           schema: T.StructType | None = None) -> int:
    """Replace rows whose key is in ``incoming``, keep the rest, insert new keys.

    Only the partitions (``partition`` values) present in ``incoming`` are read
    and rewritten, using a literal IN list so the scan is partition-pruned and
    dynamic partition overwrite leaves every other partition untouched.  The
    merged rows are a written table in the shared folder before the overwrite,
    so the write never depends on the files it replaces and a lost executor
    recomputes from that table; it is freed afterwards.  Running it twice equals running it once;
    empty input is a no-op.  Returns the number of partitions rewritten.
    """
    schema = schema or incoming.schema
    scratch = scratch_path(spark, "upsert")
    # computed once: the key check, the touched list and the merge reuse it
    incoming.select(*schema.fieldNames()).write.parquet(f"{scratch}/incoming")
    try:
        return _merge(spark, path, spark.read.schema(schema).parquet(f"{scratch}/incoming"), keys, partition, schema, scratch)
    finally:
        drop_path(spark, scratch)


def _merge(spark: SparkSession, path: str, incoming: DataFrame, keys: list[str], partition: str, schema: T.StructType, scratch: str) -> int:
    # One job gives the touched partitions (a bounded list: e.g. the dates of
    # one run) and the key check.  A key always lies in one partition (the
    # partition value is part of, or derived from, the key - else a key that
    # moved would leave its old row behind), so keys are unique when every
    # partition has as many distinct keys as rows.
    per_partition = (incoming.groupBy(partition)
                     .agg(F.count(F.lit(1)).alias("_rows"), F.count_distinct(F.struct(*keys)).alias("_keys"))
                     .collect())
    if any(r["_rows"] != r["_keys"] for r in per_partition):
        raise DuplicateKeyError(f"incoming rows repeat a key {keys}")
    touched = [r[partition] for r in per_partition]
    if not touched:
        return 0
    existing = read_table(spark, path, schema).filter(F.col(partition).isin(touched))
    kept = existing.join(incoming.select(*keys), keys, "left_anti")
    kept.unionByName(incoming).write.parquet(f"{scratch}/merged")
    merged = spark.read.schema(schema).parquet(f"{scratch}/merged")
    (merged.hint("rebalance", partition)
     .sortWithinPartitions(*keys)
     .write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition)
     .parquet(path))
    return len(touched)


def append_run(spark: SparkSession, path: str, record: dict) -> None:
    """Append one run-log record (missing counts stay null)."""
    row = {f.name: record.get(f.name) for f in RUN_LOG.fields}
    spark.createDataFrame([row], RUN_LOG).coalesce(1).write.mode("append").parquet(path)
