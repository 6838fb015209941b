"""Structured Streaming jobs.

Each job is a function of a streaming DataFrame plus sink/checkpoint paths
and returns the started ``StreamingQuery``. Sources are parameters: the same
jobs run on ``readStream.format("kafka")`` (no Kafka jar ships here, so that
path is untested) or on a file source, which the tests and registered
queries use. Candles are Spark's own windowed aggregates. The detector, the alert engine and the
per-symbol views work on micro-batches with the batch operators and carry what they need in
versioned tables (``streaming.carried``). Sinks write under the batch's id, so a restart after
executor or driver loss replays safely.
"""
from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from candlewick.functions.numeric import dec
from candlewick.functions.timecols import epoch_micros
from candlewick.operators import alerts, candles, detect
from candlewick.session import materialize, ship_package
from candlewick.sinks.messages import envelopes
from candlewick.sinks.unique import UniqueTable
from candlewick.sinks.versions import State, VersionedTable
from candlewick.sources.decode import decode_trades
from candlewick.streaming import carried

WINDOWS = (60, 300, 900)
DEFAULT_DELAY = "10 seconds"


def kafka_source(spark: SparkSession, servers: str, topic: str, starting: str = "latest",
                 max_offsets: int | None = None) -> DataFrame:
    """The broker topic as (key, value) strings. Needs the Kafka
    connector on the classpath (not present here; untested)."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("startingOffsets", starting))
    if max_offsets:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets))
    return r.load().select(F.col("offset"), F.col("key").cast("string"), F.col("value").cast("string"))


def file_source(spark: SparkSession, path: str, schema, max_files: int = 1) -> DataFrame:
    """A parquet folder as a stream, ``max_files`` files per micro-batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", str(max_files)).parquet(path)


def with_event_time(df: DataFrame) -> DataFrame:
    """Watermarks need an instant timestamp; ``u`` gives a zone-free one."""
    return df.withColumn("et", F.timestamp_micros("u"))


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def use_rocksdb_state(spark: SparkSession) -> None:
    """Keep streaming state (open windows) in RocksDB on local disk with changelog
    checkpoints, instead of executor heap. Only when the session has not
    chosen a provider (the provider of an existing checkpoint cannot change)."""
    if _PROVIDER not in spark.conf.getAll:
        spark.conf.set(_PROVIDER, ROCKSDB)


def _run(writer, checkpoint: str, trigger: dict) -> StreamingQuery:
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def candles_append(trades: DataFrame, delay: str = DEFAULT_DELAY, windows: Sequence[int] = WINDOWS) -> DataFrame:
    """X1-X3 + U2: event-time tumbling candles of every size, each emitted once, in the micro-batch whose watermark passes
    its end (append).

    Trades are aggregated once, to minutes. A closed minute goes to its window of each size, named by that window's
    ``window_time``, and a second aggregate merges them under the same watermark: a one-minute window passes through at once,
    larger ones wait for their end. State is open minutes and open larger windows, not trades. A trade that comes after its
    minute was emitted is dropped and counted in ``numRowsDroppedByWatermark``, so that a candle is always the sum of its
    minutes."""
    if any(w % 60 for w in windows):
        raise ValueError("candle sizes must be multiples of a minute")
    t = with_event_time(trades).withWatermark("et", delay)
    one = t.groupBy(F.window("et", "60 seconds").alias("w"), "symbol").agg(*candles.partial_aggs())
    one = one.withColumn("minute", F.window_time("w"))
    for w in windows:
        one = one.withColumn("w", F.window("minute", f"{w} seconds")).withColumn(f"t{w}", F.window_time("w"))
    of = F.array(*[F.struct(F.lit(w).alias("wsec"), F.col(f"t{w}").alias("last")) for w in windows])
    g = one.select("symbol", "minute", *candles.PARTIAL, F.inline(of)).groupBy("last", "symbol", "wsec").agg(
        *candles.merged_aggs("minute"))
    start = F.unix_micros("last") + 1 - F.col("wsec").cast("long") * 1_000_000
    return candles.finished(g.withColumn("ws_u", start), "wsec")


def candles_update(trades: DataFrame, lateness_s: int = 10) -> DataFrame:
    """K5 source: one aggregate keyed by (symbol, size, window start), every
    trade exploded once per size; ``update`` mode re-emits a window whenever it
    changes, and state is evicted once the watermark on the window start has
    passed it by the largest size plus the allowed lateness."""
    sizes = F.array(*[F.lit(w) for w in WINDOWS])
    t = trades.withColumn("wsec", F.explode(sizes))
    t = t.withColumn("ws_u", F.expr("(u div (wsec * 1000000)) * wsec * 1000000"))
    t = t.withColumn("ws_et", F.timestamp_micros("ws_u")).withWatermark("ws_et", f"{max(WINDOWS) + lateness_s} seconds")
    g = t.groupBy("symbol", "wsec", "ws_et", "ws_u").agg(*candles.partial_aggs())
    return candles.finished(g, "wsec").withColumn(
        "window_date", F.to_date(F.col("window_start")))


# --- jobs (source -> transformation -> idempotent sink) ---------------------

def run_candles(trades: DataFrame, out: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    use_rocksdb_state(trades.sparkSession)
    w = candles_append(trades).writeStream.outputMode("append").format("parquet").option("path", out)
    return _run(w, checkpoint, trigger or {"processingTime": "5 seconds"})


def _each_batch(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict | None,
                stateful: bool = False) -> StreamingQuery:
    """Run ``sink`` on every non-empty micro-batch. What comes out of a stateful operator is staged first, so that the
    operator runs once."""
    def run(batch: DataFrame, batch_id: int) -> None:
        batch = materialize(batch, "micro-batch") if stateful else batch.persist()
        if not batch.isEmpty():
            sink(batch, batch_id)
        if not stateful:
            batch.unpersist()

    return _run(stream.writeStream.outputMode("append").foreachBatch(run), checkpoint, trigger or {"processingTime": "5 seconds"})


CANDLE_KEYS = ["symbol", "window_seconds", "window_start"]


def run_candles_upsert(trades: DataFrame, table: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """K5: closed and open candles upserted by (symbol, window_seconds, window_start) as versions; read with
    ``VersionedTable(spark, table, CANDLE_KEYS).read()``."""
    use_rocksdb_state(trades.sparkSession)

    t = State(trades.sparkSession, table, CANDLE_KEYS)

    def sink(batch: DataFrame, batch_id: int) -> None:
        t.write(batch_id, batch.withColumn("created_at", F.current_timestamp()))  # F7

    w = candles_update(trades).writeStream.outputMode("update").foreachBatch(sink)  # one action: the aggregate runs once
    return _run(w, checkpoint, trigger or {"processingTime": "5 seconds"})


def run_detect(trades: DataFrame, out: str, checkpoint: str, trigger: dict | None = None, counters: str | None = None,
               **kw) -> StreamingQuery:
    """X5 + D-*: raw alerts as folders by batch under ``out``. The rolling baseline of a batch starts from the carried tail of
    its symbols; ``kw`` bounds its tasks as in ``detect.rolling_stats``."""
    ship_package(trades.sparkSession)
    tail = State(trades.sparkSession, out + "__tail", ["symbol"])

    def sink(batch: DataFrame, batch_id: int) -> None:
        if tail.has(batch_id):
            return
        past = carried.with_tail(batch, tail.read())
        folder = f"{out}/batch={int(batch_id)}"
        raw = carried.batch_alerts(past, **kw)
        detect.with_message(raw).write.mode("overwrite").parquet(folder)
        if counters:
            made = batch.sparkSession.read.schema(raw.schema).parquet(folder)
            _count(counters, batch_id, "detect", carried.counted(made, "alerts_generated", "alert_type", "severity"),
                   carried.counted(batch, "trades_by_symbol", "symbol"), carried.counted(batch, "trades_by_symbol_side", "symbol", "side"))
        tail.write(batch_id, carried.new_tail(past))  # last: a replay before this finds the tail before it

    return _each_batch(trades, sink, checkpoint, trigger)


def _count(path: str, batch_id: int, job: str, *parts: DataFrame) -> None:
    """Add a batch's counts once: the folder of a replayed batch is overwritten."""
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    both.write.mode("overwrite").parquet(f"{path}/job={job}/batch={int(batch_id)}")


def read_counters(spark: SparkSession, path: str) -> DataFrame:
    """Counter, label, value over all batches."""
    return spark.read.parquet(path).groupBy("counter", "label").agg(F.sum("value").alias("value"))


ALERT_COUNT_KEYS = ["gid", "name"]


def run_alerts(raw: DataFrame, table: str, checkpoint: str, trigger: dict | None = None, counters: str | None = None) -> StreamingQuery:
    """X6 + X7 + K6: accepted, escalated alerts inserted once per alert_id; ``table`` + "__counts" keeps the totals by symbol
    and severity (A5). What a batch needs of the past are the last kept alerts by type and symbol."""
    spark = raw.sparkSession
    ship_package(spark)
    kept, counts = State(spark, table + "__kept", alerts.KEYS), State(spark, table + "__counts", ALERT_COUNT_KEYS)
    unique = UniqueTable(spark, table, "alert_id", "alert_date")

    def sink(batch: DataFrame, batch_id: int) -> None:
        if kept.has(batch_id):
            return
        final = carried.batch_final(batch, kept.read()).withColumn("alert_date", F.to_date("triggered_at"))
        written = unique.insert(batch_id, final, ["u", "seq", "fan"])
        counts.write(batch_id, carried.alert_totals(written, counts.read()))
        if counters:
            sup = carried.counted(batch.join(written.select("alert_id"), "alert_id", "left_anti"), "alerts_suppressed", "alert_type")
            _count(counters, batch_id, "alerts", carried.counted(batch, "alerts_received", "alert_type"), sup,
                   carried.counted(alerts.deliveries(written), "alerts_delivered", "channel"))
        kept.write(batch_id, carried.new_kept(written))

    return _each_batch(raw, sink, checkpoint, trigger)


def read_alerts(spark: SparkSession, table: str) -> DataFrame:
    return UniqueTable(spark, table, "alert_id", "alert_date").read().drop("alert_date")


def read_alert_counts(spark: SparkSession, table: str) -> DataFrame:
    """A5 as ``alerts.alert_counts`` gives it: gid, symbol, severity, alert_count."""
    c = VersionedTable(spark, table + "__counts", ALERT_COUNT_KEYS).read()
    return c.select("gid", F.when(F.col("gid") == 1, F.col("name")).alias("symbol"), F.when(F.col("gid") == 2, F.col("name")).alias("severity"),
                    "alert_count")


def read_view(spark: SparkSession, path: str, view: str) -> DataFrame:
    """K7: a view of ``run_views``: price, trades (newest 100), series (newest 1,000 members), counts, runs."""
    return VersionedTable(spark, f"{path}/{view}", ["symbol"]).read()


def run_views(trades: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
              views: Sequence[str] = tuple(carried.VIEW_ROWS), counts: bool = True,
              view_ttl_s: int = carried.VIEW_TTL_S, counter_ttl_s: int = carried.COUNTER_TTL_S) -> StreamingQuery:
    """K7 + X8 + X12: views of each symbol, rewritten for the symbols of a batch. A symbol without a trade for ``view_ttl_s``
    of event time loses its views, one without for ``counter_ttl_s`` its counter: with the batch whose newest trade shows
    it, which deletes the rows. Trades before such a silence never come back."""
    names = [*views, *(["runs"] if views else []), *(["counts"] if counts else [])]
    t = {v: State(trades.sparkSession, f"{path}/{v}", ["symbol"]) for v in names}

    def sink(batch: DataFrame, batch_id: int) -> None:
        if counts and not t["counts"].has(batch_id):
            t["counts"].write(batch_id, carried.runs_and_gone(batch, t["counts"].read(), counter_ttl_s))
        if views and not t["runs"].has(batch_id):
            runs = carried.runs_and_gone(batch, t["runs"].read(), view_ttl_s).persist()
            for v in views:
                if not t[v].has(batch_id):
                    t[v].write(batch_id, carried.new_view(v, batch, t[v].read(), runs))
            t["runs"].write(batch_id, runs)  # last: the views of a replayed batch are made from the runs before it
            runs.unpersist()

    return _each_batch(trades, sink, checkpoint, trigger)


def run_prices(trades: DataFrame, table: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """The latest price view alone."""
    return run_views(trades, table, checkpoint, trigger or {"processingTime": "1 second"}, ["price"], False)


def run_last_candles(trades: DataFrame, table: str, checkpoint: str, trigger: dict | None = None,
                     ttl_s: int = carried.VIEW_TTL_S) -> StreamingQuery:
    """K7: the last closed candle of each symbol and size; deleted ``ttl_s`` of event time after its end."""
    use_rocksdb_state(trades.sparkSession)

    t = State(trades.sparkSession, table, ["symbol", "window_seconds"])

    def sink(batch: DataFrame, batch_id: int) -> None:
        if t.has(batch_id):
            return
        before = t.read()
        rows = carried.last_candles(batch, before).withColumn("deleted", F.lit(False))
        clock = rows.agg(F.max(epoch_micros("window_end"))).scalar()
        old = clock - epoch_micros("window_end") >= ttl_s * 1_000_000
        t.write(batch_id, rows.withColumn("deleted", old))

    return _each_batch(candles_append(trades), sink, checkpoint, trigger, True)


def run_trades_sink(messages: DataFrame, table: str, quarantine_path: str, checkpoint: str,
                    trigger: dict | None = None, counters: str | None = None) -> StreamingQuery:
    """K4 + S4 + X9-X11: decode each message once, quarantine the bad ones, insert the trades whose id is new into the trade
    table by batch and day (processed_at = load time). Redelivered trades are known by the table's key filters, so that no
    state is kept beside them and a late trade is stored like any other."""
    # accepted messages go on as their decoded columns only
    d = decode_trades(messages).withColumn("value", F.when(F.col("reason").isNotNull(), F.col("value")))

    unique = UniqueTable(messages.sparkSession, table, "trade_id", "trade_date")

    def sink(batch: DataFrame, batch_id: int) -> None:
        bad = batch.filter(F.col("reason").isNotNull()).select("offset", "key", "value", "reason")
        # a folder of its own for each batch: a replay overwrites it
        bad.write.mode("overwrite").parquet(f"{quarantine_path}/batch={int(batch_id)}")
        good = (batch.filter(F.col("reason").isNull())
                .select("trade_id", "symbol", "price", "quantity", "side", "exchange", "trader_id", "ts", "u",
                        "seq", "latency_us")
                .withColumn("trade_value", (dec("price") * dec("quantity")).cast("decimal(24,6)"))
                .withColumn("trade_date", F.to_date("ts"))
                .withColumn("ingested_at", F.current_timestamp())   # F7 load-time defaults
                .withColumn("processed_at", F.current_timestamp()))
        written = unique.insert(batch_id, good, ["u", "seq"])
        if counters:
            _count(counters, batch_id, "trades", carried.counted(written.withColumn("t", F.lit("trades")), "rows_written", "t"),
                   carried.counted(bad, "messages_rejected", "reason"))

    return _each_batch(d, sink, checkpoint, trigger)


def read_trades(spark: SparkSession, table: str) -> DataFrame:
    return UniqueTable(spark, table, "trade_id", "trade_date").read()


def run_envelopes(messages: DataFrame, channels: dict[str, str], out: str, checkpoint: str,
                  trigger: dict | None = None) -> StreamingQuery:
    """S3: the topics' messages (topic, key, value) as push-feed envelopes, each once, as files under ``out``."""
    w = envelopes(messages, channels).writeStream.outputMode("append").format("parquet").option("path", out)
    return _run(w, checkpoint, trigger or {"processingTime": "1 second"})


def progress_gauges(query: StreamingQuery) -> dict:
    """A13 gauges of a running job from its last ``StreamingQueryProgress``:
    input/processing rates, state rows, rows dropped as late, and the source
    lag (offsets available but not yet processed, when the source reports
    them, e.g. Kafka ``avgOffsetsBehindLatest``)."""
    p = query.lastProgress or {}
    ops = p.get("stateOperators", [])
    lag = None
    for src in p.get("sources", []):
        m = (src.get("metrics") or {})
        if "avgOffsetsBehindLatest" in m:
            lag = float(m["avgOffsetsBehindLatest"])
    return {
        "batch_id": p.get("batchId"),
        "input_rows": p.get("numInputRows"),
        "input_rows_per_sec": p.get("inputRowsPerSecond"),
        "processed_rows_per_sec": p.get("processedRowsPerSecond"),
        "state_rows": sum(o.get("numRowsTotal", 0) for o in ops),
        "dropped_late_rows": sum(o.get("numRowsDroppedByWatermark", 0) for o in ops),
        "watermark": (p.get("eventTime") or {}).get("watermark"),
        "offsets_behind_latest": lag,
    }
