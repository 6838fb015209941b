"""Keyed tables as append-only versions, merged when read.

A writer never touches what a reader may be reading. Each micro-batch adds a folder of its own with the new state of the
keys that it changed: all rows of a key in one batch replace every earlier row of that key, and a row with ``deleted`` set
removes it. The batch counts once a row in the log says so. A reader takes the log first and then, for each key, the rows
of its newest batch up to there, so that a batch is seen whole or not at all.

A replayed batch that is in the log is skipped; one that is not overwrites its own folder. ``compact`` writes the merged
rows as a new base and starts a new epoch of the log; ``vacuum`` deletes what only the epochs before the last one need, so
that a reader who started before a compaction can end.
"""
from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.sinks.tables import exists

NO_BASE = -1


class Commit(NamedTuple):
    base: int
    last: int


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


class VersionedTable:
    """Rows of ``keys`` under ``path``; one writer, any number of readers."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str]):
        self.spark, self.path, self.keys = spark, path, list(keys)
        self.data, self.log = f"{path}/data", f"{path}/log"
        self._schema: T.StructType | None = None

    def commit(self) -> Commit | None:
        """The newest base and the last batch; None before the first batch."""
        if not exists(self.spark, self.log):
            return None
        log = self.spark.read.schema("last long, epoch long").parquet(self.log)
        row = log.agg(F.max(F.struct("epoch", "last")).alias("m")).head()
        return Commit(row.m.epoch, row.m.last)

    def write(self, batch_id: int, rows: DataFrame, at: Commit | None) -> Commit:
        """Add the new state of some keys as batch ``batch_id``; ``at`` is the last commit. A batch that is in already is
        left alone."""
        if at is not None and at.last >= batch_id:
            return at
        out = rows if "deleted" in rows.columns else rows.withColumn("deleted", F.lit(False))
        out.write.mode("overwrite").parquet(f"{self.data}/kind=delta/batch={int(batch_id)}")
        return self._log(at.base if at else NO_BASE, batch_id)

    def _log(self, epoch: int, last: int) -> Commit:
        row = self.spark.range(1, numPartitions=1).select(F.lit(int(last)).cast("long").alias("last"))
        row.write.mode("append").parquet(f"{self.log}/epoch={int(epoch)}")
        return Commit(int(epoch), int(last))

    def versions(self, at: Commit | None) -> DataFrame | None:
        """All rows that count up to a commit, with ``batch``; None if nothing was ever written."""
        if at is None:
            return None
        if self._schema is None:
            if not exists(self.spark, self.data):
                return None
            self._schema = T.StructType([f for f in self.spark.read.parquet(self.data).schema if f.name not in ("kind", "batch")]
                                        + [T.StructField("kind", T.StringType()), T.StructField("batch", T.LongType())])
        rows, batch = self.spark.read.schema(self._schema).parquet(self.data), F.col("batch")
        return rows.where(((F.col("kind") == "base") & (batch == at.base))
                          | ((F.col("kind") == "delta") & (batch > at.base) & (batch <= at.last))).drop("kind")

    def read(self, at: Commit | None = None) -> DataFrame | None:
        """The rows of each key's newest batch up to a commit, the last one unless given."""
        rows = self.versions(at or self.commit())
        if rows is None:
            return None
        newest = Window.partitionBy(*self.keys).orderBy(F.desc("batch"))  # a group limit prunes older versions before the shuffle
        rows = rows.withColumn("__r", F.rank().over(newest)).where("__r = 1 and not deleted")
        return rows.drop("__r", "batch", "deleted")

    def compact(self) -> Commit | None:
        """Write the merged rows as a base of their own. Older folders stay for readers until ``vacuum``."""
        at = self.commit()
        merged = self.read(at)
        if merged is None or at.base == at.last:
            return at
        merged.withColumn("deleted", F.lit(False)).write.mode("overwrite").parquet(f"{self.data}/kind=base/batch={at.last}")
        return self._log(at.last, at.last)

    def vacuum(self) -> int:
        """Delete the folders that neither the newest epoch nor the one before needs; returns how many."""
        if not exists(self.spark, self.log):
            return 0
        epochs = sorted(r[0] for r in self.spark.read.parquet(self.log).select(F.col("epoch").cast("long")).distinct().collect())
        if len(epochs) < 2:
            return 0
        keep = epochs[-2]
        old = [f"{self.log}/epoch={e}" for e in epochs if e < keep]
        folders = self.spark.read.parquet(self.data).select("kind", F.col("batch").cast("long").alias("batch")).distinct().collect()
        old += [f"{self.data}/kind={r.kind}/batch={r.batch}" for r in folders
                if (r.kind == "delta" and r.batch <= keep) or (r.kind == "base" and r.batch < keep)]
        for path in old:
            _delete(self.spark, path)
        return len(old)


class State:
    """A versioned table as its one writer holds it: the commit is read once."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], compact_every: int = 100):
        self.table, self.every = VersionedTable(spark, path, keys), compact_every
        self.at = self.table.commit()

    def has(self, batch_id: int) -> bool:
        return self.at is not None and self.at.last >= batch_id

    def read(self) -> DataFrame | None:
        return self.table.read(self.at) if self.at else None

    def write(self, batch_id: int, rows: DataFrame) -> None:
        self.at = self.table.write(batch_id, rows, self.at)
        if batch_id % self.every == self.every - 1:
            self.at = self.table.compact()
            self.table.vacuum()
