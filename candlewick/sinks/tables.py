"""Idempotent table writers for ``foreachBatch``.

No table format with MERGE is assumed: inserts are ``left_anti`` against
the target, upserts rewrite only the touched partitions (dynamic partition
overwrite) from a staged copy, since Spark cannot overwrite a path it is
reading. Each micro-batch writes a marker so a replayed ``batch_id`` after a
restart is a no-op. A staged copy has a marker of its own: a replay after a
loss while the table was being overwritten publishes the finished copy again.
"""
from __future__ import annotations

import os
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def exists(spark: SparkSession, path: str) -> bool:
    """False for a missing or empty path only; any other read error is raised, since a writer that took it for "no
    table" would insert duplicates or replace the table."""
    try:
        spark.read.parquet(path).schema  # noqa: B018
        return True
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


def _marker(path: str, batch_id: int) -> str:
    return os.path.join(path + "__batches", f"batch={int(batch_id)}")


def batch_done(spark: SparkSession, path: str, batch_id: int) -> bool:
    return exists(spark, _marker(path, batch_id))


def mark_batch(spark: SparkSession, path: str, batch_id: int) -> None:
    spark.range(1).write.mode("overwrite").parquet(_marker(path, batch_id))


def _publish(merged: Callable[[], DataFrame], spark: SparkSession, staged: str, path: str,
             partition_by: Sequence[str] = ()) -> None:
    """Write ``merged()`` to ``staged``, unless an earlier attempt has finished that, and overwrite the table (or the
    partitions at hand) from the copy. ``merged`` reads the table, so it must not run again once that is half written."""
    if not batch_done(spark, staged, 0):
        merged().write.mode("overwrite").partitionBy(*partition_by).parquet(staged)
        mark_batch(spark, staged, 0)
    copy = spark.read.parquet(staged).write.mode("overwrite").partitionBy(*partition_by)
    if partition_by:
        copy = copy.option("partitionOverwriteMode", "dynamic")
    copy.parquet(path)


def insert_new(batch: DataFrame, path: str, key: str, order: list[str] | None = None,
               partition_by: list[str] | None = None) -> None:
    """K4 / K6: insert rows whose ``key`` is not in the target ("do nothing on
    conflict"); inside the batch the first row per key wins."""
    spark = batch.sparkSession
    if order:
        cols = [c for c in batch.columns if c != key]
        b = batch.groupBy(key).agg(F.min_by(F.struct(*cols), F.struct(*order)).alias("r")).select(key, "r.*")
    else:
        b = batch.dropDuplicates([key])
    if exists(spark, path):
        b = b.join(spark.read.parquet(path).select(key), key, "left_anti")
    w = b.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def upsert(batch: DataFrame, path: str, keys: list[str], partition_by: list[str], batch_id: int,
           staging: str) -> None:
    """K5: replace whole rows by key (newest batch wins) in the touched
    partitions only. ``staging`` is a folder in the shared checkpoint area,
    the same one for a replay of the batch and fresh for every other batch."""
    spark = batch.sparkSession
    _publish(lambda: _upserted(batch, path, keys, partition_by, batch_id), spark, staging, path, partition_by)


def _upserted(batch: DataFrame, path: str, keys: list[str], partition_by: list[str], batch_id: int) -> DataFrame:
    spark = batch.sparkSession
    new = batch.withColumn("__batch", F.lit(int(batch_id)).cast("long"))
    if exists(spark, path):
        touched = new.select(*partition_by).distinct()
        old = (spark.read.parquet(path).join(touched, partition_by, "left_semi")
               .withColumn("__batch", F.lit(-1).cast("long")))
        both = old.unionByName(new.select(*old.columns))
    else:
        both = new
    cols = [c for c in both.columns if c not in keys]
    merged = both.groupBy(*keys).agg(F.max_by(F.struct(*cols), "__batch").alias("r")).select(*keys, "r.*")
    return merged.drop("__batch")


def refresh(fresh: DataFrame, path: str, keys: list[str], partition_by: list[str], staging: str) -> None:
    """Replace the rows that have a key of ``fresh`` and add the new ones; all other rows of the touched
    partitions stay."""
    upsert(fresh, path, keys, partition_by, 0, staging)


def overwrite_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Replace whole partitions, those present in ``df``."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))


def export_csv(trades: DataFrame, path: str, n: int = 500) -> None:
    """K8: the newest ``n`` trades as CSV with a header (top-k, no full sort)."""
    top = trades.orderBy(F.col("u").desc(), F.col("seq").desc()).limit(n)
    (top.select("trade_id", "symbol", "price", "quantity", "side", "exchange",
                F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"))
     .coalesce(1).write.mode("overwrite").option("header", True).csv(path))


CSV_SCHEMA = ("trade_id string, symbol string, price double, quantity double, side string, exchange string, "
              "ts string")


def read_export(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.option("header", True).schema(CSV_SCHEMA).csv(path)
    return df.withColumn("ts", F.to_timestamp_ntz("ts"))


def upsert_latest(batch: DataFrame, path: str, key: str, order: list[str], staging: str) -> None:
    """X12 snapshot: one row per ``key``, the greatest ``order`` wins across
    the stored snapshot and the new batch (small table: full rewrite)."""
    spark = batch.sparkSession
    _publish(lambda: _latest(batch, path, key, order), spark, staging, path)


def _latest(batch: DataFrame, path: str, key: str, order: list[str]) -> DataFrame:
    spark = batch.sparkSession
    both = batch
    if exists(spark, path):
        both = spark.read.parquet(path).unionByName(batch.select(*spark.read.parquet(path).columns))
    cols = [c for c in both.columns if c != key]
    return both.groupBy(key).agg(F.max_by(F.struct(*cols), F.struct(*order)).alias("r")).select(key, "r.*")
