"""Raw zone and table scans."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rotorwatch.config import prepare
from rotorwatch.schemas import RAW


def read_raw(spark: SparkSession, path: str, dates: list[dt.date] | None = None) -> DataFrame:
    """All raw readings under ``path`` with partition discovery.

    The schema is declared, so a numeric-looking machine_id directory stays a
    string.  ``dates`` becomes a literal IN list: partition pruning lists only
    those ``date=`` folders.
    """
    prepare(spark)
    df = spark.read.schema(RAW).option("basePath", path).parquet(path)
    if dates is not None:
        df = df.filter(F.col("date").isin(list(dates)))
    return df.select(*RAW.fieldNames())


def new_raw_files(spark: SparkSession, path: str) -> DataFrame:
    """Stream of raw rows by file, each file once, with source_file and
    file_row (the row's index in its file, so ``file_row = 0`` marks one row
    per non-empty file).  What has been taken is in the checkpoint of the query
    that reads it, by file name: a file's time plays no part, however old."""
    prepare(spark)
    df = (spark.readStream.schema(RAW).option("maxFileAge", "36500d").parquet(path))
    return df.select("*", F.col("_metadata.file_path").alias("source_file"),
                     F.col("_metadata.row_index").alias("file_row"))


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A written table, or an empty typed DataFrame when nothing was written yet."""
    prepare(spark)
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return spark.createDataFrame([], schema)
        raise
