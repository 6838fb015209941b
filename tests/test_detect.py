from builders import trades
from pyspark.sql import functions as F

from candlewick.operators import detect


def _alerts(spark, rows):
    return detect.alerts_raw(trades(spark, rows))


def _types(df):
    return [r.alert_type for r in df.orderBy("u", "seq", "fan").collect()]


def test_four_prior_trades_no_alert(spark):
    assert _alerts(spark, [("AAPL", 100, 10, "BUY", i) for i in range(4)] + [("AAPL", 200, 100, "BUY", 5)]).count() == 0


def test_fifth_vs_sixth_trade(spark):
    rows = [("AAPL", 100, 10, "BUY", i) for i in range(5)] + [("AAPL", 120, 10, "BUY", 6)]
    assert _types(_alerts(spark, rows)) == ["CIRCUIT_BREAKER"]  # 5 prior -> baseline exists


def test_ten_percent_is_circuit_breaker(spark):
    rows = [("AAPL", 100.0, 10, "BUY", i) for i in range(10)] + [("AAPL", 110.0, 10, "BUY", 11)]
    a = _alerts(spark, rows).collect()
    assert [(r.alert_type, r.severity) for r in a] == [("CIRCUIT_BREAKER", "CRITICAL")]


def test_circuit_breaker_critical(spark):
    rows = [("AAPL", 100.0, 10, "BUY", i) for i in range(10)] + [("AAPL", 115.0, 10, "BUY", 11)]
    a = _alerts(spark, rows).collect()
    assert len(a) == 1 and a[0].severity == "CRITICAL"
    assert a[0].message == "CIRCUIT BREAKER: AAPL price moved 15.0% (avg=100.0000, current=115.0000)"


def test_price_spike_high(spark):
    rows = [("AAPL", 100.0, 10, "BUY", i) for i in range(10)] + [("AAPL", 106.0, 10, "BUY", 11)]
    a = _alerts(spark, rows).collect()
    assert [(r.alert_type, r.severity) for r in a] == [("PRICE_SPIKE", "HIGH")]


def test_volume_spike(spark):
    rows = [("AAPL", 100.0, 10, "BUY", i) for i in range(10)] + [("AAPL", 100.0, 100, "BUY", 11)]
    a = _alerts(spark, rows).collect()
    assert [(r.alert_type, r.severity, r.multiplier) for r in a] == [("VOLUME_SPIKE", "MEDIUM", 10.0)]
    assert a[0].message == "Volume spike on AAPL: 100.00 vs avg 10.00 (10.0x)"


def test_exactly_three_times_is_not_a_spike(spark):
    rows = [("AAPL", 100.0, 10, "BUY", i) for i in range(10)] + [("AAPL", 100.0, 30, "BUY", 11)]
    assert _alerts(spark, rows).count() == 0


def test_price_and_volume_on_one_trade(spark):
    rows = [("AAPL", 100.0, 10, "BUY", i) for i in range(10)] + [("AAPL", 120.0, 100, "BUY", 11)]
    assert _types(_alerts(spark, rows)) == ["CIRCUIT_BREAKER", "VOLUME_SPIKE"]


def test_stable_prices_no_alert(spark):
    rows = [("AAPL", [100.0, 100.1, 100.2][i % 3], 10, "BUY", i) for i in range(20)]
    assert _alerts(spark, rows).count() == 0


def test_symbols_independent(spark):
    rows = ([("AAPL", 100.0, 10, "BUY", i) for i in range(10)] + [("GOOGL", 50.0, 10, "BUY", i) for i in range(10)]
            + [("AAPL", 115.0, 10, "BUY", 20), ("GOOGL", 51.0, 10, "BUY", 21)])
    a = _alerts(spark, rows)
    assert [r.symbol for r in a.collect()] == ["AAPL"]


def test_oldest_leaves_baseline_after_100(spark):
    rows = [("AAPL", 200.0, 10, "BUY", 0)] + [("AAPL", 100.0, 10, "BUY", i) for i in range(1, 101)]
    s = detect.rolling_stats(trades(spark, rows)).orderBy("u").collect()
    assert s[100].n_prior == 100 and s[100].avg_price == (200.0 + 99 * 100.0) / 100  # 101st sees trade 0
    rows.append(("AAPL", 100.0, 10, "BUY", 101))
    s = detect.rolling_stats(trades(spark, rows)).orderBy("u").collect()
    assert s[101].avg_price == 100.0  # trade 0 left the window


def test_chunked_rolling_equals_single_chunk(spark):
    from paths import SF
    from candlewick.sources.fixtures import trades_from_events
    t = trades_from_events(spark, SF)
    a = detect.rolling_stats(t, chunk_rows=100_000, bucket_us=3_600_000_000)
    b = detect.rolling_stats(t, chunk_rows=100, bucket_us=60_000_000)  # many chunks, carry-in used
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert a.filter(F.col("n_prior") == 100).count() > 0
