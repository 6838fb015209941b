"""Per-call input context: builds the derived ``trades`` relation once per
query call and caches nothing across calls (each query is a fresh plan)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from candlewick.sources.fixtures import trades_from_events


class Inputs:
    def __init__(self, spark: SparkSession, sf_dir: str):
        from candlewick.session import ship_package
        ship_package(spark)  # workers run the text helper
        self.spark = spark
        self.sf_dir = sf_dir
        self._trades: DataFrame | None = None

    @property
    def trades(self) -> DataFrame:
        if self._trades is None:
            self._trades = trades_from_events(self.spark, self.sf_dir)
        return self._trades

    @property
    def stats(self) -> DataFrame:
        if getattr(self, "_stats", None) is None:
            from candlewick.operators.detect import rolling_stats
            self._stats = rolling_stats(self.trades)
        return self._stats

    @property
    def raw_alerts(self) -> DataFrame:
        if getattr(self, "_raw", None) is None:
            from candlewick.operators.detect import alerts_from_stats
            self._raw = alerts_from_stats(self.stats)  # without text; see detect.with_message
        return self._raw

    @property
    def raw_alerts_m(self) -> DataFrame:
        """Raw alerts materialised once (checkpoint), shared by the dedup and
        by any other branch of the same query that reads raw alerts."""
        if getattr(self, "_raw_m", None) is None:
            from candlewick.session import materialize
            self._raw_m = materialize(self.raw_alerts)
        return self._raw_m

    @property
    def final_alerts(self) -> DataFrame:
        if getattr(self, "_final", None) is None:
            from candlewick.operators.alerts import alerts_final
            self._final = alerts_final(self.raw_alerts_m, input_materialized=True)
        return self._final

    @property
    def candles(self) -> DataFrame:
        if getattr(self, "_candles", None) is None:
            from candlewick.operators.candles import ohlcv_all
            self._candles = ohlcv_all(self.trades)
        return self._candles
