import json

from candlewick.sources import decode

GOOD = {"trade_id": "t1", "symbol": "AAPL", "price": 182.5, "quantity": 100.0, "side": "BUY", "exchange": "NASDAQ",
        "trader_id": None, "timestamp": "2024-01-01T10:00:00.000000+00:00", "sequence": 1,
        "metadata": {"source": "x", "latency_us": 120}}


def _decode(spark, values):
    raw = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "offset long, value string")
    return {r.offset: r for r in decode.decode_trades(raw).collect()}


def test_reasons(spark):
    bad_side = dict(GOOD, side="HOLD")
    wrong_type = dict(GOOD, price="abc")
    missing = {k: v for k, v in GOOD.items() if k != "exchange"}
    extra = dict(GOOD, venue="X")
    rows = _decode(spark, [json.dumps(GOOD), "{not json", json.dumps(missing), json.dumps(extra),
                           json.dumps(wrong_type), json.dumps(bad_side), "[1, 2]",
                           json.dumps(dict(GOOD, timestamp="yesterday"))])
    assert [rows[i].reason for i in range(8)] == [None, "malformed", "missing_key", "extra_key", "bad_type",
                                                  "bad_side", "malformed", "bad_type"]
    ok = rows[0]
    assert (ok.trade_id, ok.price, ok.side, ok.seq, ok.latency_us, ok.trader_id) == ("t1", 182.5, "BUY", 1, 120, None)
    assert ok.u == 1_704_103_200_000_000


def test_offset_in_timestamp_is_honoured(spark):
    r = _decode(spark, [json.dumps(dict(GOOD, timestamp="2024-01-01T12:00:00+02:00"))])[0]
    assert r.reason is None and r.u == 1_704_103_200_000_000


def test_duplicates_keep_one(spark):
    raw = spark.createDataFrame([(0, json.dumps(GOOD)), (1, json.dumps(GOOD))], "offset long, value string")
    t = decode.dedup_trades(decode.valid_trades(decode.decode_trades(raw)))
    assert t.count() == 1


def test_alert_decode_is_lenient(spark):
    base = {"alert_id": "a", "alert_type": "PRICE_SPIKE", "severity": "HIGH", "symbol": "AAPL", "message": "m",
            "triggered_at": "2024-01-01T10:00:00+00:00"}
    vals = [json.dumps(base), json.dumps(dict(base, extra=1, details={"change_pct": 0.06})),
            json.dumps({k: v for k, v in base.items() if k != "symbol"}), "nope"]
    raw = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "offset long, value string")
    got = {r.offset: r for r in decode.decode_alerts(raw).collect()}
    assert [got[i].reason for i in range(4)] == [None, None, "missing_key", "missing_key"]
    assert got[0].details.change_pct is None and got[1].details.change_pct == 0.06


def test_fixture_stream_faults(spark):
    from paths import SF
    from candlewick.sources.fixtures import trades_from_events
    t = trades_from_events(spark, SF)
    m = decode.decode_trades(decode.fixture_messages(t))
    reasons = {r[0]: r[1] for r in m.groupBy("reason").count().collect()}
    assert set(reasons) == {None, "malformed", "missing_key", "extra_key", "bad_type", "bad_side"}
    clean = decode.dedup_trades(decode.valid_trades(m))
    assert clean.count() == reasons[None] - m.filter("reason is null and offset >= 1000000000000").count()


def test_rows_the_tables_cannot_hold(spark):
    cases = [(dict(price=999999999999.9), None), (dict(price=1e12), "out_of_range"), (dict(quantity=-1e12), "out_of_range"),
             (dict(price=1e10, quantity=1e9), "out_of_range"), (dict(symbol="S" * 20), None), (dict(symbol="S" * 21), "too_long"),
             (dict(exchange="E" * 21), "too_long"), (dict(trader_id="t" * 51), "too_long"), (dict(trader_id="t" * 50), None),
             (dict(price=float("nan")), "malformed"), (dict(quantity=float("inf")), "malformed"),  # not JSON
             (dict(side="HOLD", price=1e30), "bad_side")]
    rows = _decode(spark, [json.dumps(dict(GOOD, **c)) for c, _ in cases])
    assert [rows[i].reason for i in range(len(cases))] == [r for _, r in cases]


def test_alerts_the_table_does_not_take(spark):
    base = {"alert_id": "a", "alert_type": "PRICE_SPIKE", "severity": "HIGH", "symbol": "AAPL", "message": "m",
            "triggered_at": "2024-01-01T10:00:00+00:00"}
    cases = [({}, None), (dict(severity="LOW"), None), (dict(severity="high"), "bad_severity"), (dict(severity=""), "bad_severity"),
             (dict(severity=None), "missing_key"), (dict(symbol="S" * 21), "too_long"), (dict(alert_type="T" * 51), "too_long"),
             (dict(message="m" * 5000), None)]
    raw = spark.createDataFrame([(i, json.dumps(dict(base, **c))) for i, (c, _) in enumerate(cases)], "offset long, value string")
    got = {r.offset: r.reason for r in decode.decode_alerts(raw).collect()}
    assert [got[i] for i in range(len(cases))] == [r for _, r in cases]


def test_envelopes_skip_what_is_not_json(spark):
    from candlewick.sinks.messages import envelopes
    good = ['{"a":1}', "1", "null", '"x"', ' {"a": [1, 2]} ', "[]", '{"a":{"b":"}]"}}']
    bad = ["", "[1", "{}{}", "{}x", '{"a":1} x', '{"a":1},2', "1],[2", '{"a":1}]', '1,"b":0} {"c":1', '1,"b":0', "nope", None]
    rows = [("alerts", str(i), v) for i, v in enumerate(good + bad)] + [("other", "o", "1")]
    m = spark.createDataFrame(rows, "topic string, key string, value string")
    got = {int(r.key): json.loads(r.value) for r in envelopes(m, {"alerts": "feed"}).collect()}
    assert got == {i: {"type": "feed", "data": json.loads(v)} for i, v in enumerate(good)}
    assert envelopes(m.limit(0), {"alerts": "feed"}).count() == 0
