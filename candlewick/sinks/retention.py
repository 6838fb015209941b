"""Retention of date-partitioned tables (X14): expired days are deleted as whole folders, and a reader sees the exact horizon.

A day goes when all of it lies before the horizon, so a deleted folder never held a row that a reader may see, and a reader
that filters by the horizon sees the same rows before, during and after a deletion. Nothing is rewritten or scanned: days are
known by the names of their folders.
"""
from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.functions.timecols import epoch_micros

RETENTION_S = 30 * 86_400  # fixed value of the retention policy
_EPOCH = dt.datetime(1970, 1, 1)


def _first_day(ref_u: int, retention_s: int) -> dt.date:
    """The day on which the horizon lies: the oldest one to keep."""
    return (_EPOCH + dt.timedelta(microseconds=ref_u - retention_s * 1_000_000)).date()


def _folders(spark: SparkSession, path: str, day: str) -> list[tuple[dt.date, str]]:
    """(date, folder) of each day under ``path``, at whatever depth: a table may be cut by batch first."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    out, level = [], [root]
    while level:
        inner = []
        for folder in level:
            for s in fs.listStatus(folder):
                name = s.getPath().getName()
                at = re.fullmatch(re.escape(day) + r"=(\d{4}-\d\d-\d\d)", name)
                if at:
                    out.append((dt.date.fromisoformat(at[1]), s.getPath().toString()))
                elif s.isDirectory() and "=" in name:
                    inner.append(s.getPath())
        level = inner
    return out


def drop_expired(spark: SparkSession, path: str, day: str, ref_u: int, retention_s: int = RETENTION_S) -> list[dt.date]:
    """Delete the days of the table under ``path`` that end before ``ref_u - retention_s``; returns them, oldest first.
    ``day`` is the partition column, a date. A day of a null date stays. Deleting again changes nothing."""
    first = _first_day(ref_u, retention_s)
    old = [(d, folder) for d, folder in _folders(spark, path, day) if d < first]
    for _, folder in old:
        p = spark._jvm.org.apache.hadoop.fs.Path(folder)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    return sorted({d for d, _ in old})


def retained(table: DataFrame, day: str, ts: str, ref_u: int, retention_s: int = RETENTION_S) -> DataFrame:
    """The rows from the horizon on. The bound on ``day`` prunes folders, that on ``ts`` reaches the Parquet scan."""
    horizon = _EPOCH + dt.timedelta(microseconds=ref_u - retention_s * 1_000_000)
    bound = F.lit(horizon.isoformat(sep=" ")).cast("timestamp_ntz")
    return table.where((F.col(day) >= F.lit(horizon.date())) & (F.col(ts) >= bound))


def newest(table: DataFrame, day: str, ts: str) -> int | None:
    """Time of the newest row in microseconds, read from the newest day only; None for an empty table."""
    last = table.agg(F.max(day)).scalar()
    return table.where(F.col(day) == last).agg(F.max(epoch_micros(ts))).head()[0]
