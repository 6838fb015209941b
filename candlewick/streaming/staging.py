"""Stage derived input as time-ordered files so a file-source stream replays
it in event-time order, one micro-batch per slice (test/registration input)."""
from __future__ import annotations

import os
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.session import scratch_path

FILES, ROWS = 8, 250_000  # least number of files of a slice (the width in which it is written and read), most rows of a file


def stage_in_time_order(df: DataFrame, path: str, slices: int = 4, u: str = "u", files: int | None = None) -> int:
    """Write ``df`` as ``slices`` equal event-time slices, oldest first (the file source orders by modification time), each
    as ``files`` files by one task each. Returns that number, which is what one micro-batch has to read. By default it is the
    session's parallelism, or more where files would pass ``ROWS`` rows. A table in which a slice has fewer rows than that is
    written as one file a slice.

    The rows are made once, in one pass over all of the input that parts them by slice; the slices are copied from there."""
    spark = df.sparkSession
    lo, hi = df.agg(F.min(u), F.max(u)).head()
    if lo is None:
        df.write.mode("append").parquet(path)
        return 1
    step = (hi - lo) // slices + 1
    at = F.floor((F.col(u) - F.lit(lo)) / F.lit(step)).cast("int")
    parted = scratch_path(spark, "slices")
    df.where(F.col(u).isNotNull()).withColumn("__slice", at).write.partitionBy("__slice").parquet(parted)
    sizes = {r[0]: r[1] for r in spark.read.parquet(parted).groupBy("__slice").count().collect()}  # a row for each slice
    if files is None:
        files = max(FILES, spark.sparkContext.defaultParallelism, max(sizes.values()) // ROWS + 1)
    files = files if len(sizes) == slices and min(sizes.values()) >= 4 * files else 1
    for k in range(slices):
        part = spark.read.schema(df.schema).parquet(f"{parted}/__slice={k}") if k in sizes else df.limit(0)
        part.repartition(files).write.mode("append").parquet(path)
        time.sleep(0.02)
    return files


def subdir(root: str, name: str) -> str:
    return os.path.join(root, name)
