"""Presentation edge of registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


# means and spreads of sliding frames, merged in steps that differ between engines; all other averages are exact
AVERAGED = ("mean_vibration", "std_vibration", "zscore")


def zone_free(df: DataFrame) -> DataFrame:
    """UTC timestamps as TIMESTAMP_NTZ (zone-free, wall clock in UTC), and
    the statistics of sliding frames rounded to six decimals.  Operators and tables keep every digit."""
    def edge(f: T.StructField):
        if isinstance(f.dataType, T.TimestampType):
            return F.col(f.name).cast("timestamp_ntz").alias(f.name)
        return F.round(f.name, 6).alias(f.name) if f.name in AVERAGED else F.col(f"`{f.name}`")
    return df.select(*map(edge, df.schema.fields))
