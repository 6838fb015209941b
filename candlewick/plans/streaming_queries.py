"""Registered streaming jobs: each stages its input from the supplied tables
(time-ordered files, one micro-batch a slice), runs the job to completion with
``availableNow`` and returns the sink table, so it can be compared with the
batch twin's oracle."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick.plans.context import Inputs
from candlewick.operators import detect
from candlewick.session import materialize, scratch_path
from candlewick.sinks import messages, retention
from candlewick.sinks.versions import VersionedTable
from candlewick.sources.decode import fixture_messages
from candlewick.streaming import jobs
from candlewick.streaming.staging import stage_in_time_order, subdir

NOW = {"availableNow": True}
TOPICS = {"alerts": messages.ALERT_CHANNEL, "aggregates": messages.AGGREGATE_CHANNEL}
RETAINED_S = 5 * 86_400
SLICES = 4


def _stream(i: Inputs, df: DataFrame, root: str, u: str = "u") -> DataFrame:
    src = subdir(root, "in")
    files = stage_in_time_order(df, src, SLICES, u)
    return jobs.file_source(i.spark, src, i.spark.read.parquet(src).schema, files)


def stream_candles(i: Inputs) -> DataFrame:
    root = scratch_path(i.spark, "stream-candles")
    jobs.run_candles(_stream(i, i.trades, root), subdir(root, "out"), subdir(root, "ck"), NOW).awaitTermination()
    return i.spark.read.parquet(subdir(root, "out"))


def stream_candles_upsert(i: Inputs) -> DataFrame:
    root = scratch_path(i.spark, "stream-candles-upsert")
    jobs.run_candles_upsert(_stream(i, i.trades, root), subdir(root, "table"), subdir(root, "ck"), NOW).awaitTermination()
    return VersionedTable(i.spark, subdir(root, "table"), jobs.CANDLE_KEYS).read().drop("window_date", "created_at")


def stream_last_candles(i: Inputs) -> DataFrame:
    root = scratch_path(i.spark, "stream-last-candles")
    jobs.run_last_candles(_stream(i, i.trades, root), subdir(root, "table"), subdir(root, "ck"), NOW).awaitTermination()
    return VersionedTable(i.spark, subdir(root, "table"), ["symbol", "window_seconds"]).read()


def stream_detect(i: Inputs) -> DataFrame:
    root = scratch_path(i.spark, "stream-detect")
    jobs.run_detect(_stream(i, i.trades, root), subdir(root, "out"), subdir(root, "ck"), NOW).awaitTermination()
    return i.spark.read.parquet(subdir(root, "out")).drop("batch")


def _alerts(i: Inputs, root: str, counters: str | None = None) -> str:
    """E1 -> E2: the detector job writes raw alerts; the alert engine job reads them as its stream, in several micro-batches."""
    jobs.run_detect(_stream(i, i.trades, root), subdir(root, "raw"), subdir(root, "ck1"), NOW, counters).awaitTermination()
    raw = i.spark.read.parquet(subdir(root, "raw")).drop("batch")
    again = subdir(root, "alerts")
    stream = _stream(i, raw, again)
    jobs.run_alerts(stream, subdir(root, "table"), subdir(root, "ck2"), NOW, counters).awaitTermination()
    return subdir(root, "table")


def stream_alerts(i: Inputs) -> DataFrame:
    return jobs.read_alerts(i.spark, _alerts(i, scratch_path(i.spark, "stream-alerts")))


def stream_alert_counts(i: Inputs) -> DataFrame:
    return jobs.read_alert_counts(i.spark, _alerts(i, scratch_path(i.spark, "stream-alert-counts")))


def stream_counters(i: Inputs) -> DataFrame:
    """A9 from the jobs' own counts, once per batch."""
    root = scratch_path(i.spark, "stream-counters")
    _alerts(i, root, subdir(root, "counters"))
    _trades_sink(i, subdir(root, "sink"), subdir(root, "counters"))
    return jobs.read_counters(i.spark, subdir(root, "counters"))


def _view(i: Inputs, view: str) -> DataFrame:
    root = scratch_path(i.spark, f"stream-{view}")
    views, counts = ([], True) if view == "counts" else ([view], False)
    jobs.run_views(_stream(i, i.trades, root), subdir(root, "views"), subdir(root, "ck"), NOW, views, counts).awaitTermination()
    return jobs.read_view(i.spark, subdir(root, "views"), view)


def stream_prices(i: Inputs) -> DataFrame:
    return _view(i, "price").select("symbol", "price", "ts", "side")


def _ranked(rows: DataFrame, limit: int) -> DataFrame:
    """The newest ``limit`` rows of each symbol's view, numbered from the newest."""
    w = Window.partitionBy("symbol").orderBy(F.desc("u"), F.desc("seq"))
    return rows.withColumn("rn", F.row_number().over(w).cast("int")).where(F.col("rn") <= limit)


def stream_recent_trades(i: Inputs) -> DataFrame:
    return _ranked(_view(i, "trades"), 100).select("symbol", "price", "quantity", "side", "ts", "rn")


def stream_price_history(i: Inputs) -> DataFrame:
    rows = _ranked(_view(i, "series"), 100)
    return rows.select("symbol", "price", "ts", (F.col("u") / 1000).cast("long").alias("ms"), "rn")


def stream_trade_counts(i: Inputs) -> DataFrame:
    return _view(i, "counts").select("symbol", F.col("n").alias("trade_count"))


def _trades_sink(i: Inputs, root: str, counters: str | None = None) -> str:
    msgs = fixture_messages(i.trades)
    # topic order: each redelivered copy right after its original
    pos = (F.col("offset") % F.lit(10 ** 12)) * 2 + (F.col("offset") >= F.lit(10 ** 12)).cast("long")
    stream = _stream(i, msgs.withColumn("u", pos), root).drop("u")
    jobs.run_trades_sink(stream, subdir(root, "table"), subdir(root, "quarantine"), subdir(root, "ck"), trigger=NOW,
                         counters=counters).awaitTermination()
    return subdir(root, "table")


def stream_trades_sink(i: Inputs) -> DataFrame:
    t = jobs.read_trades(i.spark, _trades_sink(i, scratch_path(i.spark, "stream-trades-sink")))
    return t.select("trade_id", "symbol", "price", "quantity", F.col("trade_value").cast("double").alias("trade_value"),
                    "side", "exchange", "trader_id", "ts", "seq", "latency_us")


def stream_envelopes(i: Inputs) -> DataFrame:
    """S3: both topics as one stream of messages, every 17th of them followed by a cut copy of itself, which is skipped."""
    root = scratch_path(i.spark, "stream-envelopes")
    of = [("alerts", messages.alert_messages(detect.with_message(i.final_alerts))), ("aggregates", messages.candle_messages(i.candles))]
    a, c = (m.select(F.lit(topic).alias("topic"), "key", "value") for topic, m in of)
    sent = materialize(a.unionByName(c).withColumn("u", F.pmod(F.xxhash64("key", "value"), F.lit(1 << 40))), "messages")
    cut = sent.where("u % 17 = 0").withColumn("value", F.expr("substring(value, 1, length(value) - 2)"))
    stray = sent.where("u % 23 = 0").withColumn("topic", F.lit("raw-trades"))  # a topic without a channel
    stream = _stream(i, sent.unionByName(cut).unionByName(stray), root)
    jobs.run_envelopes(stream, TOPICS, subdir(root, "out"), subdir(root, "ck"), NOW).awaitTermination()
    return messages.envelope_items(i.spark.read.parquet(subdir(root, "out")))


def retained_trades_table(i: Inputs) -> DataFrame:
    """X14 on a table of days. The trades lie within one day, so their days are spread: a trade is moved back by as many
    days as its sequence number modulo 10."""
    root = scratch_path(i.spark, "retained")
    back = F.make_dt_interval(F.col("seq") % 10)
    t = i.trades.withColumn("ts", F.col("ts") - back).withColumn("trade_date", F.to_date("ts"))
    t.select("trade_id", "symbol", "price", "quantity", "side", "ts", "seq", "trade_date").write.partitionBy("trade_date").parquet(subdir(root, "trades"))
    table = i.spark.read.parquet(subdir(root, "trades"))
    ref_u = retention.newest(table, "trade_date", "ts")
    if ref_u is not None:
        retention.drop_expired(i.spark, subdir(root, "trades"), "trade_date", ref_u, RETAINED_S)
        table = retention.retained(i.spark.read.parquet(subdir(root, "trades")), "trade_date", "ts", ref_u, RETAINED_S)
    return table.drop("trade_date")
