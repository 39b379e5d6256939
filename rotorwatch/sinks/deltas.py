"""Keyed tables that are merged on reading (K2, K3, U2): a batch appends its own rows, and nothing is rewritten.

A table is a folder of batches, ``batch=<n>/<partitions>/``, and a log, ``_versions/<n>``: each entry names the batches that make up the
table, and publishing an entry is one rename.  A row of a later batch replaces the row of its key in the same partition;
one marked ``_gone`` deletes it.  ``compact`` writes the merged rows as a batch and publishes an entry with that alone.
A writer that stops at any step leaves the table as the last entry says.  A table has one writer at a time.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rotorwatch.config import drop_path, prepare

GONE, ORDER = "_gone", "_order"
COMPACT_AFTER = 50  # batches: an entry of the log and a scan list no more than these


@dataclass(frozen=True)
class DeltaTable:
    """``schema`` has the ``keys`` and the ``partitions``; a key may be in several partitions, each row for itself."""

    spark: SparkSession
    path: str
    schema: T.StructType
    keys: tuple[str, ...]
    partitions: tuple[str, ...]

    def _fs(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        return path, path(self.path).getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def version(self) -> tuple[int, list[int]]:
        """The last entry of the log and its batches, oldest first; (0, []) of a table that isn't there."""
        path, fs = self._fs()
        log = path(f"{self.path}/_versions")
        if not fs.exists(log):
            return 0, []
        entries = [int(s.getPath().getName()) for s in fs.listStatus(log) if s.getPath().getName().isdigit()]
        if not entries:
            return 0, []
        with_file = fs.open(path(log, str(max(entries))))
        try:
            return max(entries), json.loads(str(self.spark._jvm.org.apache.commons.io.IOUtils.toString(with_file, "UTF-8")))
        finally:
            with_file.close()

    def _publish(self, number: int, batches: list[int]) -> None:
        path, fs = self._fs()
        draft = path(f"{self.path}/_versions/_draft-{uuid.uuid4().hex}")
        out = fs.create(draft, True)
        out.write(bytearray(json.dumps(batches).encode()))
        out.close()
        entry = path(f"{self.path}/_versions/{number}")
        if fs.exists(entry) or not fs.rename(draft, entry):
            fs.delete(draft, False)
            raise RuntimeError(f"{self.path}: entry {number} is there already: a table takes one writer at a time")

    def _write(self, rows: DataFrame, number: int) -> None:
        """A batch's folder; what a stopped writer has left there is replaced."""
        (rows.hint("rebalance", *self.partitions).sortWithinPartitions(*self.partitions, *self.keys)
         .write.mode("overwrite").partitionBy(*self.partitions).parquet(f"{self.path}/batch={number}"))

    def append(self, rows: DataFrame, gone: DataFrame | None = None) -> int:
        """Publish ``rows`` (keys unique in a partition), and deletions of the keys in ``gone``, as one batch; its number."""
        number, batches = self.version()
        new = rows.select(*self.schema.fieldNames(), F.lit(False).alias(GONE))
        if gone is not None:
            names = set(self.keys) | set(self.partitions)
            empty = [F.col(f.name) if f.name in names else F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema.fields]
            new = new.unionByName(gone.select(*empty, F.lit(True).alias(GONE)))
        self._write(new, number + 1)
        self._publish(number + 1, [*batches, number + 1])
        if len(batches) >= COMPACT_AFTER:
            self.compact()
        return number + 1

    def read(self, where: Column | None = None) -> DataFrame:
        """The table's rows.  ``where`` may use partition columns and keys only: it prunes before the merge."""
        prepare(self.spark)
        _, batches = self.version()
        stored = T.StructType([*(f for f in self.schema.fields if f.name not in self.partitions), T.StructField(GONE, T.BooleanType()),
                               *(f for f in self.schema.fields if f.name in self.partitions)])
        if not batches:
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(T.StructType([*stored.fields, T.StructField("batch", T.LongType())])).option("basePath", self.path) \
            .parquet(*(f"{self.path}/batch={b}" for b in batches))
        rows = rows.filter(where) if where is not None else rows
        if len(batches) == 1:
            return rows.filter(~F.col(GONE)).select(*self.schema.fieldNames())
        last = Window.partitionBy(*self.partitions, *self.keys).orderBy(F.desc("batch"))
        rows = rows.withColumn(ORDER, F.row_number().over(last)).filter((F.col(ORDER) == 1) & ~F.col(GONE))
        return rows.select(*self.schema.fieldNames())

    def compact(self) -> None:
        """One batch in place of all; readers of the entry before go on with its files until :meth:`vacuum`."""
        number, batches = self.version()
        if len(batches) > 1:
            self._write(self.read().withColumn(GONE, F.lit(False)), number + 1)
            self._publish(number + 1, [number + 1])

    def vacuum(self) -> int:
        """Delete the batches that the last entry doesn't name, and older entries; how many batches went."""
        path, fs = self._fs()
        number, batches = self.version()
        gone = 0
        for s in fs.listStatus(path(self.path)):
            name = s.getPath().getName()
            if name.startswith("batch=") and int(name[6:]) not in batches and int(name[6:]) <= number:
                drop_path(self.spark, s.getPath().toString())
                gone += 1
        for s in fs.listStatus(path(f"{self.path}/_versions")):
            if s.getPath().getName() != str(number):
                fs.delete(s.getPath(), False)
        return gone
