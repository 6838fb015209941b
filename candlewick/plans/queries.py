"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Parameters that the reference sets to horizons longer than the 12-hour
fixture (30 d retention, 1 h view expiry) are registered with
shorter values so they filter something; the defaults live in the operators.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.operators import alerts, candles, detect, market, metrics, views
from candlewick.functions.numeric import dec
from candlewick.session import scratch_path
from candlewick.sinks import messages, tables
from candlewick.sinks.minute_candles import MinuteCandles
from candlewick.sources import decode
from candlewick.sources.instruments import instruments
from candlewick.plans import streaming_queries as SQ
from candlewick.plans.context import Inputs

Query = Callable[[SparkSession, str], DataFrame]

# Registered parameter values (the fixture spans 12 h)
RETENTION_S = 6 * 3_600
VIEW_TTL_S = 30
REFRESH_LAG_S = 300
COUNTER_TTL_S = 4 * 3_600
LATE_MOD = 500  # every 500th trade comes late


FINAL_COLUMNS = [
    "alert_id", "alert_type", "severity", "original_severity", "symbol", "message", "triggered_at", "trade_id",
    "seq", "fan", "breaker_state", "change_pct", "avg_price", "current_price", "threshold", "quantity",
    "avg_volume", "multiplier",
]


def _acked_table(i: Inputs) -> DataFrame:
    req = alerts.ack_requests_fixture(i.raw_alerts_m, i.final_alerts)
    return alerts.acknowledge(i.final_alerts, req)[1]


def _closed(i: Inputs, size: int) -> DataFrame:
    """Last closed candle of one size (only that size is aggregated)."""
    return candles.last_closed_candle(candles.ohlcv(i.trades, size))


def _counts(i: Inputs) -> DataFrame:
    return views.trade_counts(i.trades)


def _decoded(i: Inputs) -> DataFrame:
    return decode.decode_trades(decode.fixture_messages(i.trades))


def _trades_clean(i: Inputs) -> DataFrame:
    t = decode.dedup_trades(decode.valid_trades(_decoded(i)))
    return t.select("trade_id", "symbol", "price", "quantity",
                    (dec("price") * dec("quantity")).cast("decimal(24,6)").cast("double").alias("trade_value"),
                    "side", "exchange", "trader_id", "ts", "seq", "latency_us")


def _trade_messages(i: Inputs) -> DataFrame:
    m = messages.trade_messages(i.trades)
    p = F.from_json("value", decode.TRADE_WIRE)
    return m.select("key", p.alias("p"), F.col("headers")[0]["value"].cast("string").alias("content_type")).select(
        "key", "p.trade_id", "p.symbol", "p.price", "p.quantity", "p.side", "p.exchange", "p.trader_id",
        "p.timestamp", "p.sequence", "content_type")


def _alert_messages(i: Inputs) -> DataFrame:
    d = decode.decode_alerts(messages.alert_messages(detect.with_message(i.final_alerts)))
    return d.select("key", "reason", "alert_id", "alert_type", "severity", "symbol", "message", "triggered_at",
                    "details.*")


def _candle_messages(i: Inputs) -> DataFrame:
    m = messages.candle_messages(i.candles)
    g = lambda f, t="string": F.get_json_object("value", f"$.{f}").cast(t)
    return m.select("key", g("symbol").alias("symbol"), g("window_sec", "int").alias("window_sec"),
                    g("window_start").alias("window_start"), g("open", "double").alias("open"),
                    g("high", "double").alias("high"), g("low", "double").alias("low"),
                    g("close", "double").alias("close"), g("volume", "double").alias("volume"),
                    g("vwap", "double").alias("vwap"), g("trades", "long").alias("trades"))


def _alert_topic(i: Inputs) -> DataFrame:
    return decode.decode_alerts(decode.fixture_alert_messages(detect.with_message(i.raw_alerts_m)))


def _envelopes(i: Inputs) -> DataFrame:
    return messages.envelope_items(messages.channel_envelopes(detect.with_message(i.final_alerts), i.candles))


def _export_csv(i: Inputs) -> DataFrame:
    path = scratch_path(i.spark, "export-csv")
    tables.export_csv(i.trades, path, 500)
    return tables.read_export(i.spark, path)


def _refreshed(i: Inputs) -> DataFrame:
    """The one-minute table as it stood five minutes ago, after a refresh."""
    table = MinuteCandles(i.spark, scratch_path(i.spark, "candles-1min"))
    then = F.col("u") < i.trades.agg(F.max("u")).scalar() - F.lit(REFRESH_LAG_S * 1_000_000)
    table.load_all(0, i.trades.filter(then))
    table.log(1, i.trades.filter(~then))
    table.refresh(1, i.trades)
    return table.read()


def _refreshed_late(i: Inputs) -> DataFrame:
    """A table filled before some trades arrived, up to hours late, and refreshed after them: their minutes show."""
    table = MinuteCandles(i.spark, scratch_path(i.spark, "candles-1min-late"))
    late = F.col("seq") % LATE_MOD == 0
    table.load_all(0, i.trades.filter(~late))
    table.log(1, i.trades.filter(late))
    table.refresh(1, i.trades)
    return table.read()


def _q(fn) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Inputs(spark, sf_dir))
    run.__name__ = getattr(fn, "__name__", "query")
    return run


QUERIES: dict[str, Query] = {
    "ohlcv_1m": _q(lambda i: candles.ohlcv(i.trades, 60)),
    "ohlcv_5m": _q(lambda i: candles.ohlcv(i.trades, 300)),
    "ohlcv_15m": _q(lambda i: candles.ohlcv(i.trades, 900)),
    "ohlcv_all": _q(lambda i: candles.ohlcv_all(i.trades)),
    "candles_1min_view": _q(lambda i: candles.candles_1min_view(i.trades)),
    "candles_refresh": _q(lambda i: candles.candles_refresh(i.trades)),
    "candles_refreshed_table": _q(_refreshed),
    "candles_refreshed_late": _q(_refreshed_late),
    "last_closed_candle": _q(lambda i: candles.last_closed_candle(candles.ohlcv_all(i.trades))),
    "latest_price": _q(lambda i: views.latest_price(i.trades)),
    "latest_price_of": _q(lambda i: views.latest_price(i.trades, " sym3, SYM7 ,nope")),
    "recent_trades_of": _q(lambda i: views.recent_trades(i.trades, limit=20, symbols="sym5")),
    "recent_trades": _q(lambda i: views.recent_trades(i.trades, limit=100)),
    "price_history": _q(lambda i: views.price_history(i.trades, limit=100)),
    "trade_history": _q(lambda i: views.trade_history(i.trades, limit=100, offset=20)),
    "trade_history_far": _q(lambda i: views.trade_history(i.trades, symbol="sym3", limit=50, offset=400)),
    "trade_counts": _q(_counts),
    "active_views": _q(lambda i: views.active_views(i.trades, VIEW_TTL_S, COUNTER_TTL_S)),
    "retained_trades_table": _q(SQ.retained_trades_table),
    "retained_trades": _q(lambda i: views.retained_trades(i.trades, retention_s=RETENTION_S)),
    "rolling_stats": _q(lambda i: detect.rolling_stats(i.trades)),
    "alerts_raw": _q(lambda i: detect.with_message(i.raw_alerts)),
    "alerts_kept": _q(lambda i: detect.with_message(alerts.dedup_cooldown(i.raw_alerts_m, input_materialized=True))),
    "breaker_state": _q(lambda i: alerts.breaker_report(i.final_alerts)),
    "alerts_final": _q(lambda i: detect.with_message(i.final_alerts).select(*FINAL_COLUMNS)),
    "alert_deliveries": _q(lambda i: alerts.deliveries(detect.with_message(i.final_alerts))),
    "alert_counts": _q(lambda i: alerts.alert_counts(i.final_alerts)),
    "recent_alerts": _q(lambda i: alerts.recent_alerts(i.final_alerts, 100)),
    "alerts_filtered": _q(lambda i: alerts.alerts_filtered(_acked_table(i), symbol="sym3", severity="critical",
                                                           unacked_only=True, limit=50)),
    "alert_ack": _q(lambda i: alerts.acknowledge(i.final_alerts, alerts.ack_requests_fixture(
        i.raw_alerts_m, i.final_alerts))[0]),
    "whales": _q(lambda i: alerts.whales(i.final_alerts)),
    "pressure": _q(lambda i: market.pressure(i.trades)),
    "top_movers": _q(lambda i: market.top_movers(views.latest_price(i.trades), _closed(i, 300))),
    "market_summary": _q(lambda i: market.summary(market.symbol_activity(i.trades), i.final_alerts)),
    "symbol_stats": _q(lambda i: market.symbol_stats(views.latest_price(i.trades), _counts(i), _closed(i, 60))),
    "scanner": _q(lambda i: market.scanner(views.latest_price(i.trades), _closed(i, 300), market.pressure(i.trades))),
    "watchlist": _q(lambda i: market.watchlist(views.latest_price(i.trades), instruments(i.spark))),
    "price_levels": _q(lambda i: market.price_levels(i.trades, depth=10)),
    "trade_rate_1m": _q(lambda i: metrics.trade_rate_1m(i.trades)),
    "trade_rate_by_side": _q(lambda i: metrics.trade_rate_by_side(i.trades)),
    "alert_rate_by_severity": _q(lambda i: metrics.alert_rate_by_severity(i.raw_alerts)),
    "write_rate_by_table": _q(lambda i: metrics.write_rate_by_table(i.trades)),
    "trade_rate_sliding": _q(lambda i: metrics.trade_rate_sliding(i.trades, 60, 5)),
    "quarantine_counts": _q(lambda i: metrics.quarantine_counts(_decoded(i))),
    "alert_rate_1m": _q(lambda i: metrics.alert_rate_1m(i.raw_alerts_m, i.final_alerts)),
    "alert_increase_1h": _q(lambda i: metrics.alert_increase(i.raw_alerts_m, i.trades, 3_600)),
    "label_counters": _q(lambda i: metrics.label_counters(i.trades, i.raw_alerts_m, i.final_alerts,
                                                          alerts.deliveries(detect.with_message(i.final_alerts)))),
    "dedup_rate": _q(lambda i: metrics.dedup_rate(i.raw_alerts_m, i.final_alerts)),
    "gauges": _q(lambda i: metrics.gauges(i.trades, i.final_alerts)),
    "latency_histogram": _q(lambda i: metrics.latency_histogram(i.trades)),
    "latency_quantiles": _q(lambda i: metrics.latency_quantiles(i.trades)),
    "trades_clean": _q(_trades_clean),
    "quarantine": _q(lambda i: decode.quarantine(_decoded(i)).select("offset", "reason")),
    "trade_messages": _q(_trade_messages),
    "alert_messages": _q(_alert_messages),
    "candle_messages": _q(_candle_messages),
    "channel_envelopes": _q(_envelopes),
    "stream_envelopes": _q(SQ.stream_envelopes),
    "alert_quarantine": _q(lambda i: decode.quarantine(_alert_topic(i)).select("sent_id", "reason")),
    "alerts_accepted": _q(lambda i: _alert_topic(i).where("reason is null").select(
        "alert_id", "alert_type", "severity", "symbol", "message", "triggered_at", "u")),
    "export_csv": _q(_export_csv),
    "stream_candles": _q(SQ.stream_candles),
    "stream_candles_upsert": _q(SQ.stream_candles_upsert),
    "stream_detect": _q(SQ.stream_detect),
    "stream_alerts": _q(SQ.stream_alerts),
    "stream_prices": _q(SQ.stream_prices),
    "stream_trades_sink": _q(SQ.stream_trades_sink),
    "stream_last_candles": _q(SQ.stream_last_candles),
    "stream_recent_trades": _q(SQ.stream_recent_trades),
    "stream_price_history": _q(SQ.stream_price_history),
    "stream_trade_counts": _q(SQ.stream_trade_counts),
    "stream_alert_counts": _q(SQ.stream_alert_counts),
    "stream_counters": _q(SQ.stream_counters),
}

FLAGSHIP = "alerts_final"
