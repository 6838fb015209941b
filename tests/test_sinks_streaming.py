import os
import tempfile
import time

from builders import BASE_US, trades
from pyspark.sql import functions as F

from candlewick.operators import candles, detect
from candlewick.operators import alerts as A
from candlewick.sinks import tables
from candlewick.sources.decode import trade_json
from candlewick.streaming import jobs, staging
from candlewick.streaming.staging import stage_in_time_order


def _tmp():
    return tempfile.mkdtemp(prefix="cw-test-")


def test_upsert_replay_is_idempotent(spark):
    root = _tmp()
    path = os.path.join(root, "t")
    b = spark.createDataFrame([("k1", "d1", 1), ("k2", "d1", 2)], "k string, day string, v int")
    tables.upsert(b, path, ["k"], ["day"], 0, os.path.join(root, "s0"))
    b2 = spark.createDataFrame([("k1", "d1", 10)], "k string, day string, v int")
    tables.upsert(b2, path, ["k"], ["day"], 1, os.path.join(root, "s1"))
    tables.upsert(b2, path, ["k"], ["day"], 1, os.path.join(root, "s1b"))  # replay of batch 1
    got = {r.k: r.v for r in spark.read.parquet(path).collect()}
    assert got == {"k1": 10, "k2": 2}


def test_insert_new_ignores_existing(spark):
    path = os.path.join(_tmp(), "t")
    b = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "id string, v int")
    tables.insert_new(b, path, "id")
    tables.insert_new(b, path, "id")
    assert spark.read.parquet(path).count() == 2


def test_stream_candles_equal_batch_and_restart(spark):
    """Stream = batch on closed windows, with a stop and restart in the middle."""
    from paths import SF
    from candlewick.sources.fixtures import trades_from_events
    t = trades_from_events(spark, SF)
    root = _tmp()
    src = os.path.join(root, "in")
    lo, hi = t.agg(F.min("u"), F.max("u")).head()
    mid = (lo + hi) // 2
    stage_in_time_order(t.filter(F.col("u") < mid), src, 2, files=1)
    schema = spark.read.parquet(src).schema
    out, ck = os.path.join(root, "out"), os.path.join(root, "ck")
    jobs.run_candles(jobs.file_source(spark, src, schema), out, ck, {"availableNow": True}).awaitTermination()
    stage_in_time_order(t.filter(F.col("u") >= mid), src, 2, files=1)  # more files arrive; restart from the checkpoint
    jobs.run_candles(jobs.file_source(spark, src, schema), out, ck, {"availableNow": True}).awaitTermination()
    got = spark.read.parquet(out)
    limit = hi - 10_000_000
    want = candles.ohlcv_all(t).filter(
        F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), "window_end") <= limit)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_late_rows_dropped_and_counted(spark):
    root = _tmp()
    src = os.path.join(root, "in")
    # late rows are filtered against the previous batch's watermark, so the
    # late file comes two batches after the data that moved the watermark
    for lo in (0, 300):
        trades(spark, [("AAPL", 100, 1, "BUY", s) for s in range(lo, lo + 300, 10)]).coalesce(1) \
            .write.mode("append").parquet(src)
        time.sleep(1.1)  # the file source orders files by modification time
    late = trades(spark, [("AAPL", 999, 1, "BUY", 5)])  # 9+ minutes behind the watermark
    late.coalesce(1).write.mode("append").parquet(src)
    schema = spark.read.parquet(src).schema
    q = jobs.run_candles(jobs.file_source(spark, src, schema), os.path.join(root, "out"), os.path.join(root, "ck"),
                         {"availableNow": True})
    q.awaitTermination()
    dropped = sum(op.get("numRowsDroppedByWatermark", 0) for p in q.recentProgress for op in p["stateOperators"])
    assert dropped >= 1
    got = spark.read.parquet(os.path.join(root, "out"))
    # Spark drops a late row when its minute ended at or before the previous batch's watermark (10:04:40 here); what the
    # minute does not hold, no larger window holds
    assert got.filter(F.col("high_price") == 999).count() == 0
    assert got.filter(F.col("window_seconds") == 60).count() == 9  # 10:00 .. 10:08 closed


def test_trades_sink_keeps_late_trades_and_drops_redelivered_ones(spark):
    root = _tmp()
    src = os.path.join(root, "in")
    t = trades(spark, [("AAPL", 100 + k, 1, "BUY", 7200 * k) for k in range(4)] + [("MSFT", 5, 2, "SELL", 10)])
    m = t.select(F.col("seq").alias("offset"), F.col("symbol").alias("key"), trade_json(t).alias("value"))
    # hours later: a late trade (4), copies of trades of earlier batches (0, 2), one of the same batch (3), a bad message
    for files in ([0, 1, 1], [2], [3, 3, 0], [4, 2]):
        part = m.where("false")
        for k in files:
            part = part.unionByName(m.where(F.col("offset") == k))
        if files[0] == 4:
            part = part.unionByName(m.where("offset = 1").withColumn("value", F.lit("{bad")))
        part.coalesce(1).write.mode("append").parquet(src)
        time.sleep(1.1)
    s = jobs.file_source(spark, src, spark.read.parquet(src).schema)
    table, bad = os.path.join(root, "table"), os.path.join(root, "bad")
    jobs.run_trades_sink(s, table, bad, os.path.join(root, "ck"), trigger={"availableNow": True}).awaitTermination()
    got = jobs.read_trades(spark, table).select("trade_id", "price").collect()
    assert sorted((r.trade_id, r.price) for r in got) == [("0", 100.0), ("1", 101.0), ("2", 102.0), ("3", 103.0), ("4", 5.0)]
    assert [(r.offset, r.value, r.reason) for r in spark.read.parquet(bad).collect()] == [(1, "{bad", "malformed")]


def test_staged_slices_widen_with_their_rows(spark, monkeypatch):
    root = _tmp()
    src = os.path.join(root, "in")
    t = trades(spark, [("AAPL", 100, 1, "BUY", s) for s in range(2000)])
    monkeypatch.setattr(staging, "ROWS", 20)
    n = stage_in_time_order(t, src, 4)
    files = sorted((os.stat(os.path.join(src, f)).st_mtime_ns, f) for f in os.listdir(src) if f.endswith(".parquet"))
    assert n == 500 // 20 + 1 and len(files) == 4 * n
    seqs = [[r.seq for r in spark.read.parquet(*[os.path.join(src, f) for _, f in files[k * n : k * n + n]]).collect()] for k in range(4)]
    assert [sorted(x) for x in seqs] == [list(range(500 * k, 500 * k + 500)) for k in range(4)]


def test_chained_windows_close_without_a_trade_in_their_last_minute(spark):
    """The larger windows hang on the minutes, but close by the watermark: [10:00, 10:05) ends without a trade since 10:02,
    and its candle comes in the same micro-batch as that of a symbol that traded to the end."""
    root = _tmp()
    src = os.path.join(root, "in")
    schema = trades(spark, []).schema
    for rows in ([("GAP", 10, 2, "BUY", 1), ("GAP", 12, 1, "SELL", 119), ("FULL", 5, 1, "BUY", 30)],
                 [("FULL", 7, 1, "SELL", 295), ("FULL", 6, 0, "BUY", 299), ("ZERO", 1, 0, "BUY", 250), ("TICK", 1, 1, "BUY", 310)],
                 [("TICK", 2, 1, "BUY", 609.999999), ("FULL", 9, 1, "BUY", 600)]):
        trades(spark, rows).coalesce(1).write.mode("append").parquet(src)
        time.sleep(1.1)
    out, ck = os.path.join(root, "out"), os.path.join(root, "ck")
    q = jobs.run_candles(jobs.file_source(spark, src, schema), out, ck, {"availableNow": True})
    q.awaitTermination()
    # one aggregate over the trades, one over its minutes
    assert [op["operatorName"] for op in q.lastProgress["stateOperators"]] == ["stateStoreSave"] * 2
    read = [op["numRowsTotal"] for op in q.lastProgress["stateOperators"]]
    assert sum(read) <= 10  # open windows only
    all_trades = spark.read.parquet(src)
    end = F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), "window_end")
    limit = (BASE_US + 609_999_999 - 10_000_000) // 1000 * 1000  # a watermark counts milliseconds
    want = candles.ohlcv_all(all_trades).filter(end <= limit)
    got = spark.read.parquet(out)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    five = {r.symbol: r for r in got.filter("window_seconds = 300").collect()}
    assert set(five) == {"GAP", "FULL", "ZERO"} and five["GAP"].trade_count == 2 and five["ZERO"].vwap is None
    assert (five["FULL"].open_price, five["FULL"].close_price, five["FULL"].trade_count) == (5, 6, 3)
    assert got.filter("window_seconds = 900").count() == 0


def test_detector_and_engine_streams_equal_batch(spark):
    from paths import SF
    from candlewick.sources.fixtures import trades_from_events
    t = trades_from_events(spark, SF)
    root = _tmp()
    src = os.path.join(root, "in")
    s = jobs.file_source(spark, src, t.schema, stage_in_time_order(t, src, 3))
    jobs.run_detect(s, os.path.join(root, "raw"), os.path.join(root, "ck1"), {"availableNow": True}).awaitTermination()
    raw_stream = spark.read.parquet(os.path.join(root, "raw"))
    raw_batch = detect.alerts_raw(t)
    cols = ["alert_id", "alert_type", "u", "change_pct", "avg_price", "multiplier", "message"]
    assert raw_stream.select(cols).exceptAll(raw_batch.select(cols)).count() == 0
    assert raw_batch.count() == raw_stream.count() == 566
    rs = jobs.file_source(spark, os.path.join(root, "raw"), raw_stream.schema, max_files=64)
    jobs.run_alerts(rs, os.path.join(root, "final"), os.path.join(root, "ck2"), {"availableNow": True}).awaitTermination()
    final_stream = spark.read.parquet(os.path.join(root, "final")).select("alert_id", "severity", "breaker_state")
    final_batch = A.alerts_final(detect.alerts_from_stats(detect.rolling_stats(t))).select(
        "alert_id", "severity", "breaker_state")
    assert final_stream.exceptAll(final_batch).count() == 0 and final_batch.exceptAll(final_stream).count() == 0
    states = {r[0]: r[1] for r in final_batch.filter("breaker_state is not null").groupBy("breaker_state").count()
              .collect()}
    assert final_batch.count() == 78 + 407 + 44 and states  # counts from the fixture survey


def test_refresh_keeps_the_rest_of_the_day(spark):
    root = _tmp()
    path = os.path.join(root, "trades_1min")
    t = trades(spark, [("AAPL", 100, 1, "BUY", s) for s in range(0, 86_400 * 2, 3_600)])  # over three dates
    view = candles.candles_1min_view(t).withColumn("bucket_date", F.to_date("bucket"))
    tables.overwrite_partitions(view, path, ["bucket_date"])
    ref = t.agg(F.max("u")).head()[0]
    t2 = t.withColumn("price", F.lit(200.0))  # corrected late data for the newest minutes
    fresh = candles.candles_refresh(t2, ref_u=ref + 120_000_000).withColumn("bucket_date", F.to_date("bucket"))
    tables.refresh(fresh, path, ["bucket", "symbol"], ["bucket_date"], os.path.join(root, "staged"))
    got = [r.close_price for r in spark.read.parquet(path).orderBy("bucket").collect()]
    assert got == [100.0] * 47 + [200.0]


def test_replay_after_a_loss_while_publishing(spark):
    """The table is lost after the copy was staged: the replayed batch, which holds one key only, restores all rows."""
    for write in (lambda b, p, n, s: tables.upsert(b, p, ["k"], ["day"], n, s),
                  lambda b, p, n, s: tables.upsert_latest(b, p, "k", ["v"], s)):
        root = _tmp()
        path, staged = os.path.join(root, "t"), os.path.join(root, "s1")
        kind = "k string, day string, v int"
        write(spark.createDataFrame([("k1", "d1", 1), ("k2", "d1", 2)], kind), path, 0, os.path.join(root, "s0"))
        b2 = spark.createDataFrame([("k1", "d1", 10)], kind)
        write(b2, path, 1, staged)
        spark.createDataFrame([("k1", "d1", 10)], kind).write.mode("overwrite").partitionBy("day").parquet(path)  # half written
        write(b2, path, 1, staged)
        assert {r.k: r.v for r in spark.read.parquet(path).collect()} == {"k1": 10, "k2": 2}


def test_export_csv_round_trip(spark):
    path = os.path.join(_tmp(), "export")
    t = trades(spark, [("AAPL", 100.25, 3, "BUY", s) for s in range(600)])
    tables.export_csv(t, path, 500)
    back = tables.read_export(spark, path)
    assert back.count() == 500
    assert back.agg(F.min("ts")).head()[0] == t.orderBy(F.col("u").desc()).limit(500).agg(F.min("ts")).head()[0]


def test_registered_stream_twins_equal_batch(spark):
    """Snapshot (update mode + upsert) and candle upsert end states equal the
    batch views over the same trades."""
    from paths import SF
    from candlewick.operators import views
    from candlewick.plans.queries import QUERIES
    from candlewick.sources.fixtures import trades_from_events
    t = trades_from_events(spark, SF)
    prices = QUERIES["stream_prices"](spark, SF)
    want = views.latest_price(t)
    assert prices.exceptAll(want).count() == 0 and want.exceptAll(prices).count() == 0
    up = QUERIES["stream_candles_upsert"](spark, SF)
    allc = candles.ohlcv_all(t)
    assert up.select(allc.columns).exceptAll(allc).count() == 0 and allc.exceptAll(up.select(allc.columns)).count() == 0


def test_progress_gauges(spark):
    root = _tmp()
    src = os.path.join(root, "in")
    trades(spark, [("AAPL", 100, 1, "BUY", s) for s in range(0, 600, 10)]).coalesce(1).write.parquet(src)
    schema = spark.read.parquet(src).schema
    q = jobs.run_candles(jobs.file_source(spark, src, schema), os.path.join(root, "out"), os.path.join(root, "ck"),
                         {"availableNow": True})
    q.awaitTermination()
    g = jobs.progress_gauges(q)
    assert set(g) >= {"batch_id", "input_rows", "state_rows", "dropped_late_rows", "watermark"}
    assert g["dropped_late_rows"] == 0 and g["offsets_behind_latest"] is None  # file source reports no lag
