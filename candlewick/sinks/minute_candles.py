"""The one-minute candle table and its refresh.

The table holds versions by (bucket, symbol). Every load of trades logs the minutes it touched that the refresh range has
left behind; a refresh recomputes the range and the logged minutes, and nothing else. Trades of a refresh are read only for
the days it needs.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.functions.timecols import bucket_start_micros
from candlewick.operators.candles import candles_1min_view
from candlewick.sinks.tables import exists
from candlewick.sinks.versions import VersionedTable

DAY_US, MINUTE_US = 86_400_000_000, 60_000_000
START_OFFSET_S, END_OFFSET_S = 600, 60  # fixed values of the refresh policy


class MinuteCandles:
    def __init__(self, spark: SparkSession, path: str, start_offset_s: int = START_OFFSET_S, end_offset_s: int = END_OFFSET_S):
        self.spark, self.start, self.end = spark, start_offset_s * 1_000_000, end_offset_s * 1_000_000
        self.table = VersionedTable(spark, f"{path}/candles", ["bucket", "symbol"])
        self.changes = f"{path}/changes"

    def read(self) -> DataFrame | None:
        return self.table.read()

    def log(self, load_id: int, trades: DataFrame) -> None:
        """Note the minutes of a load, a folder for each load, so that a replay notes them once. One row a minute."""
        trades.select(bucket_start_micros("u", 60).alias("minute")).distinct().write.mode("overwrite").parquet(
            f"{self.changes}/load={int(load_id)}")

    def _stale(self, refresh_id: int, ref_u: int) -> DataFrame:
        """Minutes to recompute: those of the range, and older ones of the loads since the last refresh."""
        first, last = (ref_u - self.start + MINUTE_US - 1) // MINUTE_US, (ref_u - self.end - 1) // MINUTE_US
        stale = self.spark.range(first, last + 1).select((F.col("id") * F.lit(MINUTE_US).cast("long")).alias("minute"))
        if exists(self.spark, self.changes):
            at = self.table.commit()
            loads = self.spark.read.parquet(self.changes).where(F.col("load") <= int(refresh_id))
            if at is not None:
                loads = loads.where(F.col("load") > at.last)
            stale = stale.union(loads.where(F.col("minute") < ref_u - self.start).select("minute"))
        return stale.distinct()

    def refresh(self, refresh_id: int, trades: DataFrame, ref_u: int | None = None) -> None:
        """Bring the table up to the loads numbered ``refresh_id`` and less. ``ref_u`` is "now", the newest trade unless given.
        Refresh numbers rise; one that is in already changes nothing."""
        if ref_u is None:
            ref_u = trades.agg(F.max("u")).head()[0]
        if ref_u is None:
            return
        stale = self._stale(refresh_id, ref_u).persist()
        days = [r[0] for r in stale.select(F.expr(f"minute div {DAY_US}")).distinct().collect()]  # a few days
        own = trades.where(F.expr(f"u div {DAY_US}").isin(days)) if days else trades.limit(0)
        if days:
            first, last = min(days) * DAY_US, (max(days) + 1) * DAY_US
            own = own.where(F.col("u").between(first, last - 1))  # reaches the scan where u is stored
        own = own.withColumn("minute", bucket_start_micros("u", 60)).join(stale, "minute", "left_semi").drop("minute")
        self.table.write(refresh_id, candles_1min_view(own), self.table.commit())
        stale.unpersist()

    def load_all(self, refresh_id: int, trades: DataFrame) -> None:
        """Fill the table from all trades."""
        self.table.write(refresh_id, candles_1min_view(trades), self.table.commit())
