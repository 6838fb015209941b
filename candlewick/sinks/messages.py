"""Message encoders (K1, K2, K3, S3): a (key, value[, headers]) projection
that any Structured Streaming / batch sink (kafka, files) can take as is."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.sources.decode import iso_utc, trade_json

ALERT_CHANNEL = "alerts"
AGGREGATE_CHANNEL = "aggregates"


def trade_messages(trades: DataFrame) -> DataFrame:
    """K3: key = symbol, JSON body, content-type/source headers."""
    headers = F.array(
        F.struct(F.lit("content-type").alias("key"), F.lit("application/json").cast("binary").alias("value")),
        F.struct(F.lit("source").alias("key"), F.lit("trade-producer").cast("binary").alias("value")))
    return trades.select(F.col("symbol").alias("key"), trade_json(trades).alias("value"), headers.alias("headers"))


def alert_body(alerts: DataFrame) -> F.Column:
    """K1 body: the alert with its details object (absent keys omitted)."""
    details = F.struct(*[F.col(c).alias(c) for c in ("change_pct", "avg_price", "current_price", "threshold",
                                                    "quantity", "avg_volume", "multiplier")])
    return F.struct("alert_id", "alert_type", "severity", "symbol", "message", details.alias("details"),
                    iso_utc(F.col("triggered_at")).alias("triggered_at"))


def alert_messages(alerts: DataFrame) -> DataFrame:
    """K1: key = symbol, JSON alert."""
    return alerts.select(F.col("symbol").alias("key"), F.to_json(alert_body(alerts)).alias("value"))


def finished_candles(candles: DataFrame) -> DataFrame:
    """Closed windows only: every window but each (symbol, size)'s newest."""
    newest = candles.groupBy("symbol", "window_seconds").agg(F.max("window_start").alias("__open"))
    return (candles.join(newest, ["symbol", "window_seconds"])
            .filter(F.col("window_start") < F.col("__open")).drop("__open"))


def candle_body(candles: DataFrame) -> F.Column:
    """K2 body: the ten published candle fields."""
    return F.struct("symbol", F.col("window_seconds").alias("window_sec"),
                    iso_utc(F.col("window_start")).alias("window_start"),
                    F.col("open_price").alias("open"), F.col("high_price").alias("high"),
                    F.col("low_price").alias("low"), F.col("close_price").alias("close"),
                    F.col("total_volume").alias("volume"), "vwap", F.col("trade_count").alias("trades"))


def candle_messages(candles: DataFrame) -> DataFrame:
    """K2: key = symbol, JSON of a finished candle."""
    return finished_candles(candles).select(F.col("symbol").alias("key"), F.to_json(candle_body(candles))
                                            .alias("value"))


def is_json(value: F.Column | str) -> F.Column:
    """Whether a text is one JSON value and nothing more. Put into an array it must be its only element, and put into an
    object one of two; a text that closes the one early breaks the other."""
    v = F.col(value) if isinstance(value, str) else value
    alone = F.json_array_length(F.concat(F.lit("["), v, F.lit("]"))) == 1
    inside = F.json_object_keys(F.concat(F.lit('{"a":'), v, F.lit(',"b":0}'))) == F.array(F.lit("a"), F.lit("b"))
    return F.coalesce(alone & inside, F.lit(False))


def envelopes(messages: DataFrame, channels: dict[str, str]) -> DataFrame:
    """S3 from the topics' messages (topic, key, value), batch or stream: {type: channel, data: the message's JSON as it
    came}. Topics without a channel and messages that are not JSON are skipped."""
    channel = F.create_map(*[F.lit(x) for kv in channels.items() for x in kv])[F.col("topic")]
    ok = messages.withColumn("__channel", channel).where(F.col("__channel").isNotNull() & is_json("value"))
    return ok.select("key", F.concat(F.lit('{"type":"'), F.col("__channel"), F.lit('","data":'), F.col("value"), F.lit("}")).alias("value"))


def channel_envelopes(alerts: DataFrame, candles: DataFrame) -> DataFrame:
    """S3: the push feed {type: channel, data: payload} for both topics."""
    a = alerts.select(F.col("symbol").alias("key"), F.to_json(F.struct(
        F.lit(ALERT_CHANNEL).alias("type"), alert_body(alerts).alias("data"))).alias("value"))
    fc = finished_candles(candles)
    c = fc.select(F.col("symbol").alias("key"), F.to_json(F.struct(
        F.lit(AGGREGATE_CHANNEL).alias("type"), candle_body(fc).alias("data"))).alias("value"))
    return a.unionByName(c)


def envelope_items(envelopes: DataFrame) -> DataFrame:
    """type, key, symbol and item of each envelope: the alert's id, or the candle's size and start."""
    g = lambda f: F.get_json_object("value", f"$.{f}")
    item = F.coalesce(g("data.alert_id"), F.concat(g("data.window_sec"), F.lit("@"), g("data.window_start")))
    return envelopes.select(g("type").alias("type"), "key", g("data.symbol").alias("data_symbol"), item.alias("item"))
