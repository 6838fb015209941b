from builders import trades
from pyspark.sql import functions as F

from candlewick.operators import candles, market, metrics, views


def test_latest_and_recent(spark):
    t = trades(spark, [("AAPL", 100, 1, "BUY", 0), ("AAPL", 101, 1, "SELL", 0), ("MSFT", 5, 1, "BUY", 3)])
    lp = {r.symbol: (r.price, r.side) for r in views.latest_price(t).collect()}
    assert lp == {"AAPL": (101.0, "SELL"), "MSFT": (5.0, "BUY")}  # same instant: higher sequence wins
    assert [r.symbol for r in views.latest_price(t, symbols=" msft ,").collect()] == ["MSFT"]
    rt = views.recent_trades(t, limit=1).collect()
    assert {(r.symbol, r.price, r.rn) for r in rt} == {("AAPL", 101.0, 1), ("MSFT", 5.0, 1)}


def test_bounds(spark):
    import pytest
    t = trades(spark, [("AAPL", 100, 1, "BUY", 0)])
    with pytest.raises(ValueError):
        views.recent_trades(t, limit=101)
    with pytest.raises(ValueError):
        views.trade_history(t, limit=0)
    with pytest.raises(ValueError):
        market.price_levels(t, depth=4)


def test_pressure_zero_total(spark):
    t = trades(spark, [("AAPL", 100, 0, "BUY", 0), ("AAPL", 100, 0, "SELL", 1)])
    r = market.pressure(t).collect()[0]
    assert (r.buy_pct, r.sell_pct, r.buy_count, r.sell_count) == (50.0, 50.0, 1, 1)


def test_pressure_last_100_only(spark):
    rows = [("AAPL", 100, 1000, "BUY", 0)] + [("AAPL", 100, 1, "SELL", i) for i in range(1, 101)]
    r = market.pressure(trades(spark, rows)).collect()[0]
    assert (r.buy_volume, r.sell_volume, r.sell_pct) == (0.0, 100.0, 100.0)


def test_movers_tiny_negative_is_gainer(spark):
    # open 100 in the closed 5-minute window, latest 99.99999 -> -0.00001 % rounds to 0
    rows = [("AAPL", 100.0, 1, "BUY", 0), ("AAPL", 100.0, 1, "BUY", 301), ("AAPL", 99.99999, 1, "BUY", 302),
            ("MSFT", 100.0, 1, "BUY", 0), ("MSFT", 90.0, 1, "BUY", 301)]
    t = trades(spark, rows)
    m = {r.symbol: r for r in market.top_movers(views.latest_price(t), candles.last_closed_candle(
        candles.ohlcv_all(t))).collect()}
    assert m["AAPL"].side == "gainers" and m["AAPL"].direction == "down"
    assert m["MSFT"].side == "losers" and m["MSFT"].change_pct == -10.0


def test_summary_defaults(spark):
    t = trades(spark, [("AAPL", 100, 2, "BUY", 0)])  # no closed candle yet
    lc = candles.last_closed_candle(candles.ohlcv_all(t))
    empty = spark.createDataFrame([], "alert_id string, severity string")
    s = market.market_summary(views.latest_price(t), views.trade_counts(t), lc, empty).collect()[0]
    assert (s.active_symbols, s.total_trades, s.total_volume_1m, s.total_alerts) == (1, 1, 0.0, 0)
    st = market.symbol_stats(views.latest_price(t), views.trade_counts(t), lc).collect()[0]
    assert st.vwap_1m is None and st.daily_trades == 1


def test_price_levels(spark):
    rows = [("AAPL", 100.0, 1, "BUY", 0), ("AAPL", 99.985, 7, "SELL", 1), ("AAPL", 100.02, 3, "BUY", 2),
            ("AAPL", 100.0, 1, "BUY", 3)]
    lv = {(r.book_side, r.level): r.quantity for r in market.price_levels(trades(spark, rows)).collect()}
    assert len(lv) == 20 and lv[("bid", 2)] == 7.0 and lv[("ask", 2)] == 3.0 and lv[("bid", 1)] == 0.0


def test_trailing_count_and_views(spark):
    t = trades(spark, [("AAPL", 1, 1, "BUY", 0), ("AAPL", 1, 1, "BUY", 90_000), ("MSFT", 1, 1, "BUY", 90_000)])
    c = {r.symbol: r.trade_count for r in views.trade_counts(t).collect()}
    assert c == {"AAPL": 1, "MSFT": 1}  # the first AAPL trade is older than 24 h
    av = {r.symbol: (r.views_live, r.counter_live) for r in views.active_views(t).collect()}
    assert av == {"AAPL": (True, True), "MSFT": (True, True)}
    assert views.retained_trades(t, retention_s=3600).count() == 2


def test_latency_histogram_and_quantiles(spark):
    t = trades(spark, [("AAPL", 1, 1, "BUY", i) for i in range(10)]).withColumn(
        "latency_us", (F.col("seq") * 1000 + 500).cast("int"))
    h = {r.le: r.cumulative_count for r in metrics.latency_histogram(t).collect()}
    assert h[0.001] == 1 and h[0.005] == 5 and h[0.01] == 10 and h[float("inf")] == 10
    q = {r.quantile: r.latency_s for r in metrics.latency_quantiles(t).collect()}
    assert q[0.5] == 0.005  # rank 5 sits exactly at the 5 ms bucket bound


def test_scanner_sort(spark):
    rows = [("A", 100.0, 10, "BUY", 0), ("A", 110.0, 1, "BUY", 301), ("B", 100.0, 1, "SELL", 0),
            ("B", 90.0, 1, "SELL", 301)]
    t = trades(spark, rows)
    lc = candles.last_closed_candle(candles.ohlcv(t, 300))
    s = market.scanner(views.latest_price(t), lc, market.pressure(t), sort_by="change_pct")
    assert [r.symbol for r in s.collect()] == ["A", "B"]
    assert {r.symbol: r.signal for r in s.collect()} == {"A": "BUY", "B": "SELL"}


def test_latency_percentiles_approx_close_to_exact(spark):
    from paths import SF
    from candlewick.sources.fixtures import trades_from_events
    t = trades_from_events(spark, SF)
    approx = {r.quantile: r.latency_s for r in metrics.latency_percentiles_approx(t).collect()}
    lat = sorted(r[0] / 1e6 for r in t.select("latency_us").collect())
    for q, v in approx.items():
        exact = lat[min(len(lat) - 1, int(q * len(lat)))]
        assert abs(v - exact) <= 0.0002  # within the sketch's accuracy on 1,000 values
