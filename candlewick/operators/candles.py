"""OHLCV / VWAP candles (A1-A4), rollups (U2), last closed candle (W6) and
the one-minute continuous-aggregate refresh (X13).

Every candle is a hash aggregate on (symbol, window): Spark runs a partial
aggregate before the shuffle, so a hot symbol only costs one partial row per
map task and window. open/close are ``min_by``/``max_by`` on the ordering
struct (u, seq), not a sort.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick.functions.numeric import dec
from candlewick.functions.timecols import bucket_start_micros, ntz_from_micros

WINDOWS = (60, 300, 900)

CANDLE_COLUMNS = [
    "symbol", "window_seconds", "window_start", "window_end", "open_price", "high_price", "low_price",
    "close_price", "total_volume", "total_value", "vwap", "trade_count", "buy_volume", "sell_volume",
]


def partial_aggs() -> list:
    """The mergeable state of a window over trades (sums stay decimal until the end), for batch and stream alike."""
    ordk = F.struct("u", "seq")
    q, none = dec("quantity"), F.lit(0).cast("decimal(18,6)")
    return [
        F.min_by("price", ordk).alias("open_price"), F.max("price").alias("high_price"),
        F.min("price").alias("low_price"), F.max_by("price", ordk).alias("close_price"),
        F.sum(q).alias("vol_d"), F.sum((dec("price") * q).cast("decimal(24,6)")).alias("pv_d"),  # F1 trade_value
        F.count(F.lit(1)).alias("trade_count"),
        F.sum(F.when(F.col("side") == "BUY", q).otherwise(none)).alias("buy_d"),
        F.sum(F.when(F.col("side") != "BUY", q).otherwise(none)).alias("sell_d"),
    ]


PARTIAL = ["open_price", "high_price", "low_price", "close_price", "vol_d", "pv_d", "trade_count", "buy_d", "sell_d"]


def merged_aggs(order: str) -> list:
    """The state of a window over the states of its parts, which ``order`` puts in time order."""
    sums = [F.sum(c).alias(c) for c in PARTIAL[4:]]
    return [F.min_by("open_price", order).alias("open_price"), F.max("high_price").alias("high_price"),
            F.min("low_price").alias("low_price"), F.max_by("close_price", order).alias("close_price"), *sums]


def _partials(trades: DataFrame, window_seconds: int) -> DataFrame:
    return trades.withColumn("ws_u", bucket_start_micros("u", window_seconds)).groupBy("symbol", "ws_u").agg(*partial_aggs())


def finished(p: DataFrame, seconds: int | str) -> DataFrame:
    """Candles out of states that start at ``ws_u``; ``seconds`` is their size or the column that holds it."""
    size = F.lit(seconds) if isinstance(seconds, int) else F.col(seconds)
    vol, pv = F.col("vol_d").cast("double"), F.col("pv_d").cast("double")
    return p.select(
        "symbol", size.cast("int").alias("window_seconds"), ntz_from_micros("ws_u").alias("window_start"),
        ntz_from_micros(F.col("ws_u") + size.cast("long") * 1_000_000).alias("window_end"),
        *PARTIAL[:4], vol.alias("total_volume"), pv.alias("total_value"),
        # VWAP = sum(p*q)/sum(q); NULL for a zero-volume window
        F.when(F.col("vol_d") != 0, pv / vol).alias("vwap"),
        F.col("trade_count").cast("long").alias("trade_count"),
        F.col("buy_d").cast("double").alias("buy_volume"), F.col("sell_d").cast("double").alias("sell_volume"))


def ohlcv(trades: DataFrame, window_seconds: int = 60) -> DataFrame:
    """A1-A3: one candle per (symbol, epoch-aligned window) directly from trades."""
    return finished(_partials(trades, window_seconds), window_seconds)


def _rollup(one_min: DataFrame, window_seconds: int) -> DataFrame:
    """Roll decimal 1-minute partials up to a multiple of a minute."""
    if window_seconds % 60:
        raise ValueError("rollup needs a multiple of 60 s")
    w_us = window_seconds * 1_000_000
    return (
        one_min.withColumn("ws_big", F.expr(f"ws_u div {w_us}") * F.lit(w_us))
        .groupBy("symbol", "ws_big")
        .agg(*merged_aggs("ws_u"))
        .withColumnRenamed("ws_big", "ws_u")
    )


def ohlcv_all(trades: DataFrame, windows: tuple[int, ...] = WINDOWS) -> DataFrame:
    """Candles of every size. Trades are aggregated once to one minute;
    larger sizes roll up from the (much smaller) minute partials."""
    one = _partials(trades, 60)
    parts = []
    for w in windows:
        p = one if w == 60 else _rollup(one, w)
        parts.append(finished(p, w))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def candles_1min_view(trades: DataFrame) -> DataFrame:
    """A4: the one-minute rollup view (bucket, symbol, counts, vwap, OHLC)."""
    c = ohlcv(trades, 60)
    return c.select(
        F.col("window_start").alias("bucket"), "symbol", "trade_count", "total_volume", "vwap",
        "open_price", "high_price", "low_price", "close_price",
    )


def candles_refresh(trades: DataFrame, ref_u: int | None = None, start_offset_s: int = 600,
                    end_offset_s: int = 60) -> DataFrame:
    """Recompute only the one-minute buckets in [ref - start, ref - end).

    ``ref_u`` (epoch microseconds) defaults to the newest trade. The filter is
    on ``u`` so it prunes before the aggregate. Written back by
    ``sinks.tables.refresh``, which keeps the other buckets of the day.
    """
    ref = trades.agg(F.max("u")).scalar() if ref_u is None else F.lit(ref_u)  # scalar subquery
    lo = ref - F.lit(start_offset_s * 1_000_000)
    hi = ref - F.lit(end_offset_s * 1_000_000)
    b = bucket_start_micros("u", 60)
    return candles_1min_view(trades.filter((b >= lo) & (b < hi)))


def last_closed_candle(candles: DataFrame) -> DataFrame:
    """Per (symbol, window_seconds) the newest window that is closed, i.e.
    the symbol already has a trade in a later window of that size (its newest
    window is still open): the second newest. A group limit keeps two candles
    a key and task before the shuffle, so the candles are built once."""
    cols = ["window_start", "window_end", "open_price", "high_price", "low_price", "close_price",
            "total_volume", "vwap", "trade_count"]
    newest = Window.partitionBy("symbol", "window_seconds").orderBy(F.desc("window_start"))
    two = candles.select("symbol", "window_seconds", *cols, F.row_number().over(newest).alias("rn")).where("rn <= 2")
    return two.where("rn = 2").drop("rn")
