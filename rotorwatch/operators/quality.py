"""Validation and quarantine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rotorwatch.config import REQUIRED_FIELDS
from rotorwatch.functions import any_null
from rotorwatch.schemas import READING


def missing_columns(schema: T.StructType, required=REQUIRED_FIELDS) -> list[str]:
    """Required columns that the schema lacks."""
    have = set(schema.fieldNames())
    return [c for c in required if c not in have]


def conform(df: DataFrame, required=REQUIRED_FIELDS) -> DataFrame:
    """Add each missing required column as typed nulls, so its rows are quarantined
    instead of the file being skipped."""
    types = {f.name: f.dataType for f in READING.fields}
    for c in missing_columns(df.schema, required):
        df = df.withColumn(c, F.lit(None).cast(types.get(c, T.StringType())))
    return df


def is_incomplete(required=REQUIRED_FIELDS):
    return any_null(required)


def split_valid(readings: DataFrame, required=REQUIRED_FIELDS) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantined): a row is quarantined when any required field is null."""
    readings = conform(readings, required)
    bad = is_incomplete(required)
    return readings.filter(~bad), readings.filter(bad)


def validation_summary(readings: DataFrame, required=REQUIRED_FIELDS) -> DataFrame:
    """One row: rows_validated, rows_quarantined - a single pass with map-side partial counts."""
    readings = conform(readings, required)
    return readings.agg(F.count(F.lit(1)).alias("rows_validated"),
                        F.count_if(is_incomplete(required)).alias("rows_quarantined"))


def validation_report(readings: DataFrame, by, required=REQUIRED_FIELDS) -> DataFrame:
    """Per group (a source file, or a raw-zone partition): rows, rows that fail
    validation, and ``missing_columns`` - the required columns without a single
    value in the group, comma-separated (empty when none).  Read under the
    declared schema, a column a file lacks is null in all its rows, so it is
    listed here while its rows are quarantined.  One aggregation with partial
    counts before the shuffle."""
    readings = conform(readings, required)
    present = [F.count(F.col(c)).alias(f"_present_{c}") for c in required]
    counts = readings.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"),
                                       F.count_if(is_incomplete(required)).alias("rows_quarantined"), *present)
    missing = F.concat_ws(",", *[F.when(F.col(f"_present_{c}") == 0, F.lit(c)) for c in required])
    return counts.select(*by, "rows", "rows_quarantined", missing.alias("missing_columns"))

