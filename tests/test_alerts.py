import random

from builders import alerts, ids
from pyspark.sql import functions as F

from candlewick.operators import alerts as A


def test_second_alert_inside_cooldown_dropped(spark):
    a = alerts(spark, [("PRICE_SPIKE", "AAPL", 0), ("PRICE_SPIKE", "AAPL", 10)])
    assert ids(A.dedup_cooldown(a)) == ["a0"]


def test_cooldowns_per_type(spark):
    rows = [("PRICE_SPIKE", "AAPL", 0), ("PRICE_SPIKE", "AAPL", 59), ("PRICE_SPIKE", "AAPL", 60),
            ("CIRCUIT_BREAKER", "AAPL", 0), ("CIRCUIT_BREAKER", "AAPL", 299), ("CIRCUIT_BREAKER", "AAPL", 300),
            ("VOLUME_SPIKE", "AAPL", 0), ("VOLUME_SPIKE", "AAPL", 29), ("VOLUME_SPIKE", "AAPL", 30),
            ("OTHER", "AAPL", 0), ("OTHER", "AAPL", 59.999999), ("OTHER", "AAPL", 60)]
    assert ids(A.dedup_cooldown(alerts(spark, rows))) == sorted(["a0", "a2", "a3", "a5", "a6", "a8", "a9", "a11"])


def test_suppressed_alert_does_not_extend_cooldown(spark):
    rows = [("PRICE_SPIKE", "AAPL", 0), ("PRICE_SPIKE", "AAPL", 50), ("PRICE_SPIKE", "AAPL", 100),
            ("PRICE_SPIKE", "AAPL", 130)]
    assert ids(A.dedup_cooldown(alerts(spark, rows))) == ["a0", "a2"]


def test_exact_boundary_microsecond(spark):
    rows = [("PRICE_SPIKE", "AAPL", 0), ("PRICE_SPIKE", "AAPL", 59.999999), ("PRICE_SPIKE", "GOOGL", 0),
            ("PRICE_SPIKE", "GOOGL", 60)]
    assert ids(A.dedup_cooldown(alerts(spark, rows))) == ["a0", "a2", "a3"]


def test_breaker_states(spark):
    rows = [("PRICE_SPIKE", "AAPL", 0),               # never tripped -> CLOSED
            ("CIRCUIT_BREAKER", "AAPL", 10),          # trip
            ("PRICE_SPIKE", "AAPL", 70),              # OPEN -> escalated
            ("PRICE_SPIKE", "AAPL", 310),             # exactly 5 min after trip -> OPEN
            ("PRICE_SPIKE", "AAPL", 370.000001),      # > 5 min -> HALF_OPEN
            ("PRICE_SPIKE", "GOOGL", 80)]             # other symbol -> CLOSED
    f = A.alerts_final(alerts(spark, rows)).orderBy("u").collect()
    got = [(r.alert_id, r.breaker_state, r.severity) for r in f if r.alert_type == "PRICE_SPIKE"]
    assert got == [("a0", "CLOSED", "HIGH"), ("a2", "OPEN", "CRITICAL"), ("a5", "CLOSED", "HIGH"),
                   ("a3", "OPEN", "CRITICAL"), ("a4", "HALF_OPEN", "CRITICAL")]


def test_suppressed_breaker_does_not_reopen(spark):
    rows = [("CIRCUIT_BREAKER", "AAPL", 0), ("CIRCUIT_BREAKER", "AAPL", 200),  # second is suppressed
            ("PRICE_SPIKE", "AAPL", 400)]  # 400 s after the accepted trip -> HALF_OPEN, not OPEN
    f = A.alerts_final(alerts(spark, rows)).filter(F.col("alert_type") == "PRICE_SPIKE").collect()
    assert [r.breaker_state for r in f] == ["HALF_OPEN"]


def test_reset_option(spark):
    rows = [("CIRCUIT_BREAKER", "AAPL", 0), ("PRICE_SPIKE", "AAPL", 4000)]
    a = alerts(spark, rows)
    kept = A.dedup_cooldown(a)
    st = A.breaker_states(kept, reset_after_s=3600).filter(F.col("alert_type") == "PRICE_SPIKE").collect()
    assert [r.breaker_state for r in st] == ["CLOSED"]


def test_routing(spark):
    rows = [("OTHER", "AAPL", 0, "LOW"), ("PRICE_SPIKE", "AAPL", 0, "HIGH"), ("CIRCUIT_BREAKER", "MSFT", 0, "CRITICAL"),
            ("VOLUME_SPIKE", "AAPL", 0, "MEDIUM")]
    f = alerts(spark, rows)
    d = {(r.alert_id, r.channel) for r in A.deliveries(f).collect()}
    assert d == {("a0", "log_low"), ("a1", "webhook_stub"), ("a1", "log_high"), ("a2", "webhook_stub"),
                 ("a2", "log_critical"), ("a3", "log_medium")}
    hooked = {(r.alert_id, r.channel) for r in A.deliveries(f, webhook_url="https://example.invalid/h").collect()}
    assert ("a1", "webhook") in hooked
    p = [r.payload for r in A.deliveries(f).collect() if r.channel == "webhook_stub" and r.alert_id == "a1"][0]
    assert '"text":"*[HIGH] PRICE_SPIKE*\\nTest alert for AAPL"' in p


def _walk(rows):
    """Kept ids by walking the alerts in order; rows: (type, symbol, seconds)."""
    last, out = {}, []
    for i, (kind, sym, t) in sorted(enumerate(rows), key=lambda x: (x[1][2], x[0])):
        cd, before = A.COOLDOWNS_S.get(kind, A.DEFAULT_COOLDOWN_S), last.get((kind, sym))
        if before is None or t - before >= cd:
            last[kind, sym] = t
            out.append(f"a{i}")
    return sorted(out)


def test_dedup_equals_walk_at_every_bucket_width(spark):
    rng = random.Random(5)
    rows = []
    for kind in ("PRICE_SPIKE", "VOLUME_SPIKE", "CIRCUIT_BREAKER"):
        t = 0
        for _ in range(150):  # dense runs, gaps around a cooldown, long silences, repeated instants
            t += rng.choice([0, 1, 7, 13, 29, 30, 31, 59, 60, 61, 299, 300, 301, 2000])
            rows.append((kind, rng.choice(["HOT", "HOT", "AAPL"]), t))
    a, want = alerts(spark, rows).checkpoint(), _walk(rows)
    for cooldowns in (1, 3, 720):
        assert ids(A.dedup_cooldown(a, cooldowns=cooldowns)) == want


def test_equal_instant_and_sequence_keeps_one(spark):
    a = alerts(spark, [("PRICE_SPIKE", "AAPL", 0)] * 3).withColumn("seq", F.lit(1).cast("long"))
    assert ids(A.dedup_cooldown(a)) == ids(A.dedup_cooldown(a, cooldowns=1)) == ["a0"]


def test_hundred_thousand_alerts_without_a_pause(spark):
    n, step = 100_000, 7
    a = spark.range(n).select(
        F.format_string("a%06d", "id").alias("alert_id"), F.lit("PRICE_SPIKE").alias("alert_type"),
        F.lit("HOT").alias("symbol"), (F.col("id") * step * 1_000_000).alias("u"), F.col("id").alias("seq"))
    want = [f"a{i:06d}" for i in range(0, n, 9)]  # 9 * 7 s is the first gap of 60 s or more
    assert ids(A.dedup_cooldown(a)) == want
    assert ids(A.dedup_cooldown(a, cooldowns=200)) == want


def test_prefix_bucket_width_does_not_matter(spark):
    from paths import SF
    from candlewick.operators.detect import alerts_raw
    from candlewick.sources.fixtures import trades_from_events
    raw = alerts_raw(trades_from_events(spark, SF)).checkpoint()
    a = A.alerts_final(raw).select("alert_id", "severity", "breaker_state")
    b = A.alerts_final(raw, bucket_us=30_000_000).select("alert_id", "severity", "breaker_state")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_ack_first_wins(spark):
    f = A.alerts_final(alerts(spark, [("CIRCUIT_BREAKER", "AAPL", 0)]))
    req = spark.createDataFrame([("a0", 1, "api-user"), ("a0", 2, "desk-2"), ("nope", 1, "api-user")],
                                "alert_id string, req_u long, acknowledged_by string")
    status, table = A.acknowledge(f, req)
    st = {(r.alert_id, r.acknowledged_by): r.status for r in status.collect()}
    assert st == {("a0", "api-user"): "acknowledged", ("a0", "desk-2"): "not_found", ("nope", "api-user"): "not_found"}
    row = table.collect()[0]
    assert row.acknowledged and row.acknowledged_by == "api-user"
    assert A.alerts_filtered(table, unacked_only=True).count() == 0


def test_dense_keys_get_narrow_buckets_and_null_keys_stay(spark):
    rng = random.Random(11)
    rows = [("PRICE_SPIKE", "HOT", rng.randrange(0, 3_000_000) / 1000) for _ in range(1500)] + [("PRICE_SPIKE", "B", 400 * k) for k in range(9)]
    rows = [r + ("HIGH",) for r in sorted(rows, key=lambda r: r[2])]
    a = alerts(spark, rows)
    want = _walk([r[:3] for r in rows])
    cells = A._cells(a, 720, 100).groupBy("symbol", "b").count()
    assert cells.agg(F.max("count")).head()[0] <= 120 and cells.where("symbol = 'B'").count() == 1
    assert ids(A.dedup_cooldown(a, rows=100)) == ids(A.dedup_cooldown(a)) == sorted(f"a{i}" if isinstance(i, int) else i for i in want)
    odd = alerts(spark, [("PRICE_SPIKE", "A", 0), ("PRICE_SPIKE", "A", 5)])
    odd = odd.withColumn("symbol", F.lit(None).cast("string")).unionByName(odd.withColumn("alert_id", F.concat(F.lit("t"), "alert_id")).withColumn(
        "alert_type", F.lit(None).cast("string")))
    assert ids(A.dedup_cooldown(odd)) == ["a0", "ta0"]


def test_symbol_activity_equals_the_views(spark):
    from builders import trades
    from candlewick.operators import candles, market, views
    day = 86_400
    t = trades(spark, [("A", 1, 2, "BUY", 0), ("A", 1, 3, "BUY", 70), ("A", 1, 4, "SELL", 75), ("A", 1, 5, "BUY", 2 * day),
                       ("B", 1, 6, "BUY", 10), ("C", 1, 7, "BUY", 2 * day - 100), ("C", 1, 8, "BUY", 2 * day), ("C", 1, 9, "BUY", 2 * day + 1)])
    got = {r.symbol: (r.trade_count, r.volume_1m) for r in market.symbol_activity(t).collect()}
    counts = {r.symbol: r.trade_count for r in views.trade_counts(t).collect()}
    closed = {r.symbol: r.total_volume for r in candles.last_closed_candle(candles.ohlcv(t, 60)).collect()}
    assert got == {s: (counts.get(s), closed.get(s)) for s in "ABC"} and counts == {"A": 1, "C": 3}
