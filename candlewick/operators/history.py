"""Paging through the trade table by seeking.

A page far back is found by counting, not by sorting what lies before it: rows per minute come from a small index (or one
counting pass), are added up by day, hour and minute, and inside the minute by second down to the microsecond. At each step
the interval that holds the page's first row is looked up among at most a few hundred counts. What is sorted at last is the
rows of a few intervals about as large as the page.
"""
from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.functions.timecols import bucket_start_micros, idiv

MINUTE_US = 60_000_000
COARSE = (86_400_000_000, 3_600_000_000, MINUTE_US)  # widths the index can answer
FINE = (1_000_000, 10_000, 100, 1)


class Place(NamedTuple):
    first: int  # interval that holds the row
    last: int
    newer: int  # rows behind the interval


def count_index(trades: DataFrame) -> DataFrame:
    """symbol, at (minute start), n. Stored beside the table, it grows by one row a symbol and minute."""
    return trades.groupBy("symbol", bucket_start_micros("u", 60).alias("at")).agg(F.count(F.lit(1)).alias("n"))


def locate(trades: DataFrame, index: DataFrame, position: int, enough: int) -> Place | None:
    """Where the row at ``position`` (0: the newest) lies: an interval of at most ``enough`` rows, or one instant. None if
    there are not so many rows."""
    lo, hi, newer = None, None, 0
    for width in COARSE + FINE:
        rows = index if width in COARSE else trades.select(F.col("u").alias("at"), F.lit(1).alias("n"))
        if lo is not None:
            rows = rows.where(F.col("at").between(lo, hi))
        counts = rows.groupBy(idiv("at", width).alias("k")).agg(F.sum("n").alias("n")).collect()
        found = None
        for k, n in sorted(counts, reverse=True):
            if newer + n > position:
                found = k, n
                break
            newer += n
        if found is None:
            return None
        lo, hi = found[0] * width, (found[0] + 1) * width - 1
        if found[1] <= enough:
            break
    return Place(lo, hi, newer)


def seek(trades: DataFrame, index: DataFrame, limit: int, offset: int) -> tuple[int, int, int] | None:
    """(first u, last u, rows to skip) of the page; None if the table ends before it."""
    start = locate(trades, index, offset, limit)
    if start is None:
        return None
    end = locate(trades, index, offset + limit - 1, limit)
    return end.first if end else 0, start.last, offset - start.newer


def page(trades: DataFrame, limit: int, offset: int, index: DataFrame | None = None) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` of the trades, newest first by (u, seq)."""
    newest = [F.col("u").desc(), F.col("seq").desc()]
    if not offset:
        return trades.orderBy(*newest).limit(limit)
    at = seek(trades, index if index is not None else count_index(trades).persist(), limit, offset)
    if at is None:
        return trades.limit(0)
    first, last, skip = at
    return trades.where(F.col("u").between(first, last)).orderBy(*newest).offset(skip).limit(limit)
