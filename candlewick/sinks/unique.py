"""Insert if absent without reading the target (K4, K6).

Beside the table lies a key filter: for each day and shard of the key's hash, a Bloom filter of the keys that a batch
inserted. A micro-batch is tested against these few bytes a key. Keys that hit nothing are new for sure; only for possible
hits are the days that they point to read, and matched exactly. Without conflicts no file of the table is opened.

Every batch writes its rows and filters to folders of its own, so a replay overwrites them and cannot meet its own rows.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.sinks.tables import exists

SHARDS = 64
BITS, HASHES = 24, 12  # bits of a filter for each key, hash functions: about one false hit in 100,000 keys


def _places(h1: np.ndarray, h2: np.ndarray, size: int) -> np.ndarray:
    """Bits of each key in a filter of ``size`` bits, a power of two."""
    k = np.arange(HASHES, dtype=np.uint64)
    h1, h2 = h1.view(np.uint64)[:, None], h2.view(np.uint64)[:, None] | np.uint64(1)
    return ((h1 + k * h2) >> np.uint64(7)) & np.uint64(size - 1)


def bloom(h1: np.ndarray, h2: np.ndarray) -> bytes:
    size = 1 << max(6, (BITS * len(h1)).bit_length())
    bits = np.zeros(size, bool)
    bits[_places(h1, h2, size)] = True
    return np.packbits(bits).tobytes()


def may_hold(data: bytes, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(data, np.uint8))
    return bits[_places(h1, h2, len(bits))].all(axis=1)


def _by_shard(batches, group):
    """Runs ``group(shard, table)`` over rows sorted by shard."""
    shard, held = None, []
    for batch in batches:
        names = batch.column("shard").to_numpy()
        cut = [0, *(np.flatnonzero(np.diff(names)) + 1).tolist(), len(names)]
        for a, b in zip(cut[:-1], cut[1:]):
            if a == b:
                continue
            if held and names[a] != shard:
                yield from group(shard, pa.Table.from_batches(held))
                held = []
            shard = int(names[a])
            held.append(batch.slice(a, b - a))
    if held:
        yield from group(shard, pa.Table.from_batches(held))


def _filters(batches):
    """shard, day, h1, h2 -> a filter for each shard and day."""
    def group(shard, t):
        day = t.column("day").to_numpy(zero_copy_only=False).astype("datetime64[D]")
        h1, h2 = t.column("h1").to_numpy(), t.column("h2").to_numpy()
        days = np.unique(day)
        data = [bloom(h1[day == d], h2[day == d]) for d in days]
        yield pa.RecordBatch.from_arrays([pa.array([shard] * len(days), pa.int32()), pa.array(days, pa.date32()), pa.array(data, pa.binary())],
                                         ["shard", "day", "bits"])

    return _by_shard(batches, group)


def _hits(batches):
    """Keys of a shard, then its filters -> keys that a day's filter may hold. Filters pass one at a time."""
    shard, held = None, []
    for batch in batches:
        names = batch.column("shard").to_numpy()
        is_key = batch.column("is_key").to_numpy(zero_copy_only=False)
        cut = np.flatnonzero((names[1:] != names[:-1]) | (is_key[1:] != is_key[:-1])) + 1
        keys, days = [], []
        for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(names)]):
            if a == b:
                continue
            if names[a] != shard:
                shard, held = names[a], []
            part = batch.slice(a, b - a)
            if is_key[a]:
                held.append(part.select(["key", "h1", "h2"]))
            elif held:
                t = pa.Table.from_batches(held).combine_chunks()
                held = t.to_batches()
                h1, h2 = t.column("h1").to_numpy(), t.column("h2").to_numpy()
                for day, bits in zip(part.column("day"), part.column("bits")):
                    found = t.column("key").take(pa.array(np.flatnonzero(may_hold(bits.as_py(), h1, h2)))).to_pylist()
                    keys += found
                    days += [day.as_py()] * len(found)
        if keys:
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(days, pa.date32())], ["key", "day"])


class UniqueTable:
    """Rows under ``path`` with a unique ``key``, partitioned by batch and by the date column ``day``.

    A redelivered row has the event time of the first, so a key is looked up ``days`` days around the row's own day; None
    looks it up in the whole table. ``shards`` must not change during the table's life.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, day: str, days: int | None = 1, shards: int = SHARDS):
        self.spark, self.path, self.key, self.day, self.days, self.shards = spark, path, key, day, days, shards
        self.filters = f"{path}__keys"

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.path).drop("batch")

    def _hashed(self, df: DataFrame) -> DataFrame:
        k = F.col(self.key).cast("string")
        h1 = F.xxhash64(k)
        return df.select(k.alias("key"), F.pmod(h1, F.lit(self.shards)).cast("int").alias("shard"), h1.alias("h1"),
                         F.xxhash64(k, F.lit(1)).alias("h2"), F.col(self.day).alias("day"))

    def possible_conflicts(self, rows: DataFrame, batch_id: int) -> DataFrame | None:
        """key, day: keys of ``rows`` that a filter of another batch may hold; None without filters."""
        if not exists(self.spark, self.filters):
            return None
        known = self.spark.read.parquet(self.filters).where(F.col("batch") != int(batch_id)).drop("batch")
        if self.days is not None:
            first, last = rows.agg(F.date_sub(F.min(self.day), self.days), F.date_add(F.max(self.day), self.days)).head()
            known = known.where(F.col("day").between(F.lit(first), F.lit(last)))
        both = self._hashed(rows).drop("day").withColumn("is_key", F.lit(True)).unionByName(known.withColumn("is_key", F.lit(False)), True)
        both = both.repartition("shard").sortWithinPartitions("shard", F.desc("is_key"))
        return both.mapInArrow(_hits, "key string, day date")

    def _taken(self, rows: DataFrame, maybe: DataFrame, days: list, batch_id: int) -> DataFrame:
        """The keys among the possible conflicts that the table holds, by reading the days they point to."""
        target = self.spark.read.parquet(self.path).where(F.col(self.day).isin(days) & (F.col("batch") != int(batch_id)))
        there = target.select(F.col(self.key).alias("__key"), F.col(self.day).alias("__day")).join(
            maybe.select(F.col("key").alias("__maybe")).distinct(), F.expr("cast(__key as string) = __maybe"), "left_semi")
        own = rows.select(self.key, self.day).join(there, F.col(self.key) == F.col("__key"))
        if self.days is not None:
            own = own.where(F.abs(F.datediff(self.day, "__day")) <= self.days)
        return own.select(self.key).distinct()

    def insert(self, batch_id: int, rows: DataFrame, order: list[str] | None = None) -> DataFrame:
        """Insert the rows whose key is new; of several rows of the batch with one key the first by ``order`` counts.
        Returns this batch's rows as written."""
        others = [c for c in rows.columns if c != self.key]
        first = F.min_by(F.struct(*others), F.struct(*order)) if order else F.first(F.struct(*others))
        rows = rows.groupBy(self.key).agg(first.alias("r")).select(self.key, "r.*").persist()
        maybe, new = self.possible_conflicts(rows, batch_id), rows
        if maybe is not None:
            maybe = maybe.persist()
            days = [r[0] for r in maybe.select("day").distinct().collect()]  # at most the days looked up
            if days:
                new = rows.join(self._taken(rows, maybe, days, batch_id), self.key, "left_anti")
        out = f"{self.path}/batch={int(batch_id)}"
        new.write.mode("overwrite").partitionBy(self.day).parquet(out)
        keys = self._hashed(new).repartition("shard").sortWithinPartitions("shard")
        keys = keys.mapInArrow(_filters, "shard int, day date, bits binary")
        keys.write.mode("overwrite").partitionBy("day").parquet(f"{self.filters}/batch={int(batch_id)}")
        if maybe is not None:
            maybe.unpersist()
        rows.unpersist()
        return self.spark.read.schema(new.schema).parquet(out)
