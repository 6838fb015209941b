"""Market views (A6, A7, J1, J2, J3, J6, T3, T6, watchlist).

All inputs are one-row-per-symbol views (latest price, counters, last closed
candle, pressure), so these joins are between small, symbol-keyed relations;
they are plain equi-joins and AQE turns them into broadcast joins at runtime
when the measured side is under ``autoBroadcastJoinThreshold`` (a size
check, not an assumption). Only the instrument dimension is broadcast
unconditionally: it has a fixed ten rows.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick.functions.numeric import dec
from candlewick.functions.timecols import bucket_start_micros
from candlewick.operators.views import RECENT_N, latest_price, recent_trades

# Scanner signal thresholds (ours; the reference gives no rule)
SIGNAL_BUY_PCT = 60.0
SIGNAL_SELL_PCT = 40.0
TICK_FRACTION = 1e-4  # one basis point of the mid price


def pressure(trades: DataFrame, n: int = RECENT_N) -> DataFrame:
    """buy/sell volume, share and count over each symbol's newest ``n``
    trades; 50/50 when the total volume is 0. Shares are unrounded doubles
    (D11: rounding is presentation)."""
    last = recent_trades(trades, limit=n).withColumn("q", dec("quantity"))
    is_buy = F.col("side") == "BUY"
    zero = F.lit(0).cast("decimal(18,6)")
    g = last.groupBy("symbol").agg(
        F.sum(F.when(is_buy, F.col("q")).otherwise(zero)).alias("buy_d"),
        F.sum(F.when(~is_buy, F.col("q")).otherwise(zero)).alias("sell_d"),
        F.sum(F.when(is_buy, 1).otherwise(0)).cast("long").alias("buy_count"),
        F.sum(F.when(~is_buy, 1).otherwise(0)).cast("long").alias("sell_count"),
    )
    total = F.col("buy_d") + F.col("sell_d")
    share = lambda c: F.when(total != 0, F.col(c).cast("double") / total.cast("double") * 100).otherwise(50.0)
    return g.select(
        "symbol", F.col("buy_d").cast("double").alias("buy_volume"), F.col("sell_d").cast("double").alias("sell_volume"),
        share("buy_d").alias("buy_pct"), share("sell_d").alias("sell_pct"), "buy_count", "sell_count",
    )


def _change_pct(cur: F.Column, open_: F.Column) -> F.Column:
    return F.when(open_ != 0, (cur - open_) / open_ * 100).otherwise(F.lit(0.0))


def top_movers(latest: DataFrame, last_closed: DataFrame, k: int = 5) -> DataFrame:
    """J1 + T3: latest price vs the open of the last closed 5-minute candle
    (inner join: symbols missing either side are skipped). The change is rounded
    to 4 places first; the direction goes by the unrounded one. Gainers are
    rows whose change is >= 0; biggest |change| first, ties by symbol; top
    ``k`` per side."""
    c5 = last_closed.filter(F.col("window_seconds") == 300).select(
        "symbol", F.col("open_price").alias("open"), F.col("total_volume").alias("volume"), "vwap")
    m = latest.select("symbol", "price").join(c5, "symbol", "inner")
    m = m.withColumn("change", _change_pct(F.col("price"), F.col("open")))
    m = m.withColumn("direction", F.when(F.col("change") >= 0, "up").otherwise("down"))
    m = m.withColumn("change_pct", F.round("change", 4))
    m = m.withColumn("side", F.when(F.col("change_pct") >= 0, "gainers").otherwise("losers"))
    order = [F.abs(F.col("change_pct")).desc(), F.col("symbol")]
    top = None
    for side in ("gainers", "losers"):
        part = m.filter(F.col("side") == side).orderBy(*order).limit(k)  # top-k: no full sort
        top = part if top is None else top.unionByName(part)
    w = Window.partitionBy("side").orderBy(*order)  # at most 2k rows here
    return top.withColumn("rank", F.row_number().over(w).cast("int")).select(
        "side", "rank", "symbol", "price", "open", "change_pct", "direction", "volume", "vwap")


def symbol_activity(trades: DataFrame, ttl_s: int = 86_400) -> DataFrame:
    """symbol, trade_count, volume_1m in one pass over the trades: the counter (A8: it starts anew after ``ttl_s`` of
    silence; null where the symbol has been silent for so long at the newest trade) and the volume of the last closed
    minute (null without one). Both follow from one row a symbol and minute."""
    ttl = ttl_s * 1_000_000
    m = trades.groupBy("symbol", bucket_start_micros("u", 60).alias("minute")).agg(
        F.count(F.lit(1)).alias("n"), F.min("u").alias("first_u"), F.max("u").alias("last_u"), F.sum(dec("quantity")).alias("v"))
    back = Window.partitionBy("symbol").orderBy(F.desc("minute"))  # newest first: the present run is what lies before a gap
    gap = F.lag("first_u").over(back) - F.col("last_u") >= ttl
    m = m.select("*", F.row_number().over(back).alias("rn"), F.coalesce(gap.cast("int"), F.lit(0)).alias("gap"))
    m = m.select("*", F.sum("gap").over(back).alias("gaps"))
    s = m.groupBy("symbol").agg(F.sum(F.when(F.col("gaps") == 0, F.col("n"))).alias("n"), F.max("last_u").alias("last_u"),
                                F.max(F.when(F.col("rn") == 2, F.col("v"))).alias("volume_1m"))
    now = F.max("last_u").over(Window.partitionBy(F.lit(0)))  # one row a symbol here
    return s.select("symbol", F.when(now - F.col("last_u") < ttl, F.col("n")).alias("trade_count"), "volume_1m")


def market_summary(latest: DataFrame, counts: DataFrame, last_closed: DataFrame, final_alerts: DataFrame) -> DataFrame:
    """J2 + A7: one row: active symbols, sum of their trade counters, last
    closed 1-minute volume (missing -> 0), alert totals (escalated), from
    views at hand; ``summary`` takes ``symbol_activity`` instead."""
    c1 = last_closed.filter(F.col("window_seconds") == 60).select(
        "symbol", F.col("total_volume").cast("decimal(24,6)").alias("volume_1m"))
    return summary(latest.select("symbol").join(counts, "symbol", "left").join(c1, "symbol", "left"), final_alerts)


def summary(activity: DataFrame, final_alerts: DataFrame) -> DataFrame:
    """J2 + A7 from symbol, trade_count, volume_1m and the alerts."""
    s = activity.agg(
        F.count(F.lit(1)).alias("active_symbols"),
        F.sum(F.coalesce(F.col("trade_count"), F.lit(0))).cast("long").alias("total_trades"),
        F.round(F.sum(F.coalesce(F.col("volume_1m"), F.lit(0).cast("decimal(24,6)"))), 2).cast("double")
        .alias("total_volume_1m"),
    )
    a = final_alerts.agg(
        F.count(F.lit(1)).alias("total_alerts"),
        F.coalesce(F.sum(F.when(F.col("severity") == "CRITICAL", 1).otherwise(0)), F.lit(0)).cast("long")
        .alias("critical_alerts"),
        F.coalesce(F.sum(F.when(F.col("severity") == "HIGH", 1).otherwise(0)), F.lit(0)).cast("long")
        .alias("high_alerts"),
    )
    # two one-row aggregates side by side: union them and take each column's
    # only non-null value (each side is computed once; no join)
    cols = s.columns + a.columns
    both = s.unionByName(a, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in cols])


def symbol_stats(latest: DataFrame, counts: DataFrame, last_closed: DataFrame) -> DataFrame:
    """Per symbol price, trade counter (0 if none), last closed
    1-minute VWAP and volume (NULL if none)."""
    c1 = last_closed.filter(F.col("window_seconds") == 60).select(
        "symbol", F.col("vwap").alias("vwap_1m"), F.col("total_volume").alias("volume_1m"))
    return (latest.select("symbol", "price").join(counts, "symbol", "left").join(c1, "symbol", "left")
            .select("symbol", "price", F.coalesce("trade_count", F.lit(0)).cast("long").alias("daily_trades"),
                    "vwap_1m", "volume_1m"))


def scanner(latest: DataFrame, last_closed: DataFrame, press: DataFrame, sort_by: str | None = None,
            descending: bool = True) -> DataFrame:
    """J6 + T5: one row per symbol: price, change vs the last closed 5-minute
    open, 5-minute VWAP/volume, buy share and a BUY/SELL/NEUTRAL signal
    (our rule: buy share >= 60 -> BUY, <= 40 -> SELL); optionally sorted by
    any output column."""
    c5 = last_closed.filter(F.col("window_seconds") == 300).select(
        "symbol", F.col("open_price").alias("open_5m"), F.col("vwap").alias("vwap_5m"),
        F.col("total_volume").alias("volume_5m"))
    j = latest.select("symbol", "price").join(c5, "symbol", "left").join(press.select("symbol", "buy_pct"), "symbol",
                                                                          "left")
    sig = (F.when(F.col("buy_pct") >= SIGNAL_BUY_PCT, "BUY").when(F.col("buy_pct") <= SIGNAL_SELL_PCT, "SELL")
           .otherwise("NEUTRAL"))
    out = j.select("symbol", "price", "open_5m",
                   F.when(F.col("open_5m").isNotNull(), _change_pct(F.col("price"), F.col("open_5m")))
                   .alias("change_pct"), "vwap_5m", "volume_5m", "buy_pct", sig.alias("signal"))
    if sort_by:
        key = F.col(sort_by).desc_nulls_last() if descending else F.col(sort_by).asc_nulls_last()
        out = out.orderBy(key, "symbol")
    return out


def watchlist(latest: DataFrame, instruments: DataFrame) -> DataFrame:
    """Watchlist: latest price with the instrument's asset class and venue."""
    return latest.join(F.broadcast(instruments), "symbol", "inner").select(
        "asset_class", "symbol", "instrument", "exchange", "price", "ts")


def price_levels(trades: DataFrame, depth: int = 10, n: int = RECENT_N) -> DataFrame:
    """T6 (re-aimed order book): a ``depth``-level ladder each side of the
    latest price ``mid`` (tick = 1 bp of it, spread two ticks) with the real
    quantity of the symbol's newest ``n`` trades that fall into each level;
    prices rounded to 6 places, totals to 4. Level of a trade =
    ceil(|price - mid| / tick), found arithmetically, then an equi-join on
    (symbol, book_side, level): no band join."""
    if not 5 <= depth <= 20:
        raise ValueError("depth must be in [5, 20]")
    mid = latest_price(trades).select("symbol", F.col("price").alias("mid"))
    mid = mid.withColumn("tick", F.col("mid") * F.lit(TICK_FRACTION))
    ladder = (mid.withColumn("book_side", F.explode(F.array(F.lit("bid"), F.lit("ask"))))
              .withColumn("level", F.explode(F.sequence(F.lit(1), F.lit(depth)))))
    last = recent_trades(trades, limit=n).join(mid, "symbol")
    d = F.abs(F.col("price") - F.col("mid"))
    binned = (last.filter(d > 0)
              .withColumn("book_side", F.when(F.col("price") < F.col("mid"), "bid").otherwise("ask"))
              .withColumn("level", F.ceil(d / F.col("tick")).cast("int"))
              .filter(F.col("level") <= depth)
              .groupBy("symbol", "book_side", "level").agg(F.sum(dec("quantity")).alias("q")))
    out = ladder.join(binned, ["symbol", "book_side", "level"], "left")
    px = F.when(F.col("book_side") == "bid", F.col("mid") - F.col("tick") * F.col("level")) \
        .otherwise(F.col("mid") + F.col("tick") * F.col("level"))
    qty = F.coalesce(F.col("q"), F.lit(0).cast("decimal(18,6)")).cast("double")
    px = F.round(px, 6)
    return out.select("symbol", "mid", F.round(F.col("tick") * 2, 8).alias("spread"), "book_side", "level",
                      px.alias("price"), qty.alias("quantity"), F.round(px * qty, 4).alias("total"))
