from builders import trades
from pyspark.sql import functions as F

from candlewick.operators import candles


def _one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_single_trade_one_open_window(spark):
    t = trades(spark, [("AAPL", 100, 100, "BUY", 0)])
    c = candles.ohlcv_all(t)
    assert c.count() == 3  # one open window per size
    assert candles.last_closed_candle(c).count() == 0  # nothing closed yet


def test_ohlcv_values(spark):
    t = trades(spark, [("AAPL", 100, 10, "BUY", 0), ("AAPL", 105, 20, "SELL", 5), ("AAPL", 95, 5, "BUY", 10)])
    r = _one(candles.ohlcv(t, 60))
    assert (r.open_price, r.high_price, r.low_price, r.close_price) == (100, 105, 95, 95)
    assert r.total_volume == 35 and r.trade_count == 3


def test_vwap(spark):
    t = trades(spark, [("AAPL", 100, 10, "BUY", 0), ("AAPL", 200, 10, "BUY", 1)])
    assert _one(candles.ohlcv(t, 60)).vwap == 150.0


def test_window_closes_on_next_minute(spark):
    t = trades(spark, [("AAPL", 100, 1, "BUY", 0), ("AAPL", 101, 1, "BUY", 60)])
    closed = candles.last_closed_candle(candles.ohlcv_all(t))
    assert [r.window_seconds for r in closed.collect()] == [60]  # 300/900 still open


def test_buy_sell_volume(spark):
    t = trades(spark, [("AAPL", 100, 100, "BUY", 0), ("AAPL", 100, 50, "SELL", 1)])
    r = _one(candles.ohlcv(t, 60))
    assert (r.buy_volume, r.sell_volume) == (100, 50)


def test_rollup_equals_direct(spark):
    from paths import SF
    from candlewick.sources.fixtures import trades_from_events
    t = trades_from_events(spark, SF)
    rolled = candles.ohlcv_all(t).filter(F.col("window_seconds") == 900)
    direct = candles.ohlcv(t, 900)
    assert rolled.exceptAll(direct).count() == 0 and direct.exceptAll(rolled).count() == 0


def test_refresh_range(spark):
    from candlewick.functions.timecols import epoch_micros
    t = trades(spark, [("AAPL", 100, 1, "BUY", s) for s in range(0, 1200, 30)])
    ref = t.agg(F.max("u")).head()[0]
    r = candles.candles_refresh(t, ref_u=ref).select(epoch_micros("bucket").alias("b"))
    lo, hi = ref - 600_000_000, ref - 60_000_000
    starts = [row.b for row in r.collect()]
    assert len(starts) == 9 and all(lo <= b < hi for b in starts)


def test_results_do_not_depend_on_session_time_zone(spark):
    from paths import SF
    from candlewick.sources.fixtures import trades_from_events
    utc = candles.ohlcv(trades_from_events(spark, SF), 300).collect()
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        ny = candles.ohlcv(trades_from_events(spark, SF), 300).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert sorted(utc) == sorted(ny)
