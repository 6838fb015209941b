"""DuckDB oracle SQL for the registered queries.

Each statement recomputes the query from the raw tables independently of the
Spark code (window functions, recursive CTEs), so agreement is evidence. The
``trades`` CTE is the SQL twin of ``sources.fixtures``.
"""
from __future__ import annotations

from candlewick.plans import queries as Q
from candlewick.sources.fixtures import TRADES_SQL
from candlewick.sources.instruments import instruments_sql

D = "DECIMAL(18,6)"


def _with(*ctes: str) -> str:
    rec = "RECURSIVE " if any("walk" in c for c in ctes) else ""
    return f"WITH {rec}trades AS (" + TRADES_SQL + ")" + "".join(", " + c for c in ctes) + "\n"


def _ohlcv_cte(name: str, w: int) -> str:
    wu = w * 1_000_000
    return f"""{name} AS (
  SELECT symbol, {w} AS window_seconds, make_timestamp(ws_u) AS window_start, make_timestamp(ws_u + {wu}) AS window_end,
         open_price, high_price, low_price, close_price,
         CAST(vol_d AS DOUBLE) AS total_volume, CAST(pv_d AS DOUBLE) AS total_value,
         CASE WHEN vol_d <> 0 THEN CAST(pv_d AS DOUBLE) / CAST(vol_d AS DOUBLE) END AS vwap,
         trade_count, CAST(buy_d AS DOUBLE) AS buy_volume, CAST(sell_d AS DOUBLE) AS sell_volume, ws_u
  FROM (
    SELECT symbol, (u // {wu}) * {wu} AS ws_u,
           arg_min(price, (u, seq)) AS open_price, max(price) AS high_price, min(price) AS low_price,
           arg_max(price, (u, seq)) AS close_price,
           sum(CAST(quantity AS {D})) AS vol_d,
           sum(CAST(CAST(price AS {D}) * CAST(quantity AS {D}) AS DECIMAL(24,6))) AS pv_d,
           count(*) AS trade_count,
           sum(CASE WHEN side = 'BUY' THEN CAST(quantity AS {D}) ELSE 0 END) AS buy_d,
           sum(CASE WHEN side <> 'BUY' THEN CAST(quantity AS {D}) ELSE 0 END) AS sell_d
    FROM trades GROUP BY symbol, (u // {wu}) * {wu}))"""


CANDLE_COLS = ("symbol, window_seconds, window_start, window_end, open_price, high_price, low_price, close_price, "
               "total_volume, total_value, vwap, trade_count, buy_volume, sell_volume")

ALL_CANDLES = ", ".join([_ohlcv_cte("c60", 60), _ohlcv_cte("c300", 300), _ohlcv_cte("c900", 900)]) + \
    f", candles AS (SELECT * FROM c60 UNION ALL SELECT * FROM c300 UNION ALL SELECT * FROM c900)"

REF = "ref AS (SELECT max(u) AS ref_u FROM trades)"
# a counter that expires after 24 h without a trade and counts every trade until then
COUNTS = """counter AS (
  SELECT symbol, u, sum(CASE WHEN u - prev >= 86400000000 THEN 1 ELSE 0 END) OVER (PARTITION BY symbol ORDER BY u, seq) AS run
  FROM (SELECT symbol, u, seq, lag(u) OVER (PARTITION BY symbol ORDER BY u, seq) AS prev FROM trades)),
counts AS (
  SELECT symbol, trade_count FROM (
    SELECT symbol, run, count(*) AS trade_count, max(u) AS last_u,
           row_number() OVER (PARTITION BY symbol ORDER BY run DESC) AS rn
    FROM counter GROUP BY symbol, run), ref
  WHERE rn = 1 AND ref_u - last_u < 86400000000)"""
FINISHED = """finished AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol, window_seconds ORDER BY window_start DESC) AS rn FROM candles)
  WHERE rn > 1)"""

ROLLING = f"""stats AS (
  SELECT trade_id, symbol, price, quantity, side, ts, u, seq,
         CAST(least(row_number() OVER w - 1, 100) AS INTEGER) AS n_prior,
         CASE WHEN row_number() OVER w - 1 >= 5 THEN CAST(sum(CAST(price AS {D})) OVER p AS DOUBLE) / count(*) OVER p END AS avg_price,
         CASE WHEN row_number() OVER w - 1 >= 5 THEN CAST(sum(CAST(quantity AS {D})) OVER p AS DOUBLE) / count(*) OVER p END AS avg_volume
  FROM trades
  WINDOW w AS (PARTITION BY symbol ORDER BY u, seq),
         p AS (PARTITION BY symbol ORDER BY u, seq ROWS BETWEEN 100 PRECEDING AND 1 PRECEDING))"""

RAW_ALERTS = """raw_alerts AS (
  SELECT sha256(trade_id || '|' || alert_type) AS alert_id, alert_type, severity, symbol, message,
         ts AS triggered_at, trade_id, u, seq, fan, change_pct, avg_price, current_price, threshold,
         quantity, avg_volume, multiplier
  FROM (
    SELECT trade_id, symbol, ts, u, seq,
           CASE WHEN chg >= 0.10 THEN 'CIRCUIT_BREAKER' ELSE 'PRICE_SPIKE' END AS alert_type,
           CASE WHEN chg >= 0.10 THEN 'CRITICAL' ELSE 'HIGH' END AS severity,
           CASE WHEN chg >= 0.10
                THEN 'CIRCUIT BREAKER: ' || symbol || ' price moved ' || printf('%.1f%%', chg * 100) ||
                     ' (avg=' || printf('%.4f', avg_price) || ', current=' || printf('%.4f', price) || ')'
                ELSE 'Price spike on ' || symbol || ': ' || printf('%.1f%%', chg * 100) ||
                     ' move (avg=' || printf('%.4f', avg_price) || ', current=' || printf('%.4f', price) || ')'
           END AS message,
           0 AS fan, chg AS change_pct, avg_price, price AS current_price,
           CASE WHEN chg >= 0.10 THEN 0.10 ELSE 0.05 END::DOUBLE AS threshold,
           NULL::DOUBLE AS quantity, NULL::DOUBLE AS avg_volume, NULL::DOUBLE AS multiplier
    FROM (SELECT *, CASE WHEN avg_price IS NOT NULL AND avg_price <> 0 THEN abs(price - avg_price) / avg_price END AS chg
          FROM stats)
    WHERE chg >= 0.05
    UNION ALL
    SELECT trade_id, symbol, ts, u, seq, 'VOLUME_SPIKE', 'MEDIUM',
           'Volume spike on ' || symbol || ': ' || printf('%.2f', quantity) || ' vs avg ' || printf('%.2f', avg_volume) ||
           ' (' || printf('%.1f', quantity / avg_volume) || 'x)',
           1, NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE, quantity, avg_volume, quantity / avg_volume
    FROM stats WHERE avg_volume IS NOT NULL AND avg_volume <> 0 AND quantity > avg_volume * 3.0))"""


def _ohlcv_sql(w: int) -> str:
    return _with(_ohlcv_cte("c", w)) + f"SELECT {CANDLE_COLS} FROM c"


ORACLE: dict[str, str] = {
    "ohlcv_1m": _ohlcv_sql(60),
    "ohlcv_5m": _ohlcv_sql(300),
    "ohlcv_15m": _ohlcv_sql(900),
    "ohlcv_all": _with(ALL_CANDLES) + f"SELECT {CANDLE_COLS} FROM candles",
    "candles_1min_view": _with(_ohlcv_cte("c", 60)) +
    "SELECT window_start AS bucket, symbol, trade_count, total_volume, vwap, open_price, high_price, low_price, "
    "close_price FROM c",
    "candles_refresh": _with(_ohlcv_cte("c", 60), REF) +
    "SELECT window_start AS bucket, symbol, trade_count, total_volume, vwap, open_price, high_price, low_price, "
    "close_price FROM c, ref WHERE ws_u >= ref_u - 600000000 AND ws_u < ref_u - 60000000",
    "candles_refreshed_table": _with(
        _ohlcv_cte("c", 60), REF, f"earlier AS (SELECT trades.* FROM trades, ref WHERE u < ref_u - {Q.REFRESH_LAG_S * 1_000_000})",
        _ohlcv_cte("c_then", 60).replace("FROM trades", "FROM earlier")) + """
SELECT window_start AS bucket, symbol, trade_count, total_volume, vwap, open_price, high_price, low_price, close_price
FROM (SELECT c.* FROM c, ref WHERE ws_u >= ref_u - 600000000 AND ws_u < ref_u - 60000000
      UNION ALL
      SELECT c_then.* FROM c_then, ref WHERE NOT (ws_u >= ref_u - 600000000 AND ws_u < ref_u - 60000000))""",
    "candles_refreshed_late": _with(
        _ohlcv_cte("c", 60), REF, f"early AS (SELECT * FROM trades WHERE seq % {Q.LATE_MOD} <> 0)",
        _ohlcv_cte("c_early", 60).replace("FROM trades", "FROM early"),
        f"stale AS (SELECT DISTINCT (u // 60000000) * 60000000 AS ws_u FROM trades WHERE seq % {Q.LATE_MOD} = 0)") + """
, fresh AS (SELECT ws_u >= ref_u - 600000000 AND ws_u < ref_u - 60000000 OR
                   ws_u < ref_u - 600000000 AND ws_u IN (SELECT ws_u FROM stale) AS is_fresh, c.* FROM c, ref)
SELECT window_start AS bucket, symbol, trade_count, total_volume, vwap, open_price, high_price, low_price, close_price
FROM (SELECT * EXCLUDE (is_fresh) FROM fresh WHERE is_fresh
      UNION ALL BY NAME
      SELECT * FROM c_early WHERE (symbol, ws_u) NOT IN (SELECT (symbol, ws_u) FROM fresh WHERE is_fresh))""",
    "last_closed_candle": _with(ALL_CANDLES) + """
SELECT symbol, window_seconds, window_start, window_end, open_price, high_price, low_price, close_price,
       total_volume, vwap, trade_count
FROM (SELECT *, row_number() OVER (PARTITION BY symbol, window_seconds ORDER BY window_start DESC) AS rn FROM candles)
WHERE rn = 2""",
    "latest_price": _with() + """
SELECT symbol, price, ts, side FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY u DESC, seq DESC) AS rn FROM trades) WHERE rn = 1""",
    "recent_trades": _with() + """
SELECT symbol, price, quantity, side, ts, CAST(rn AS INTEGER) AS rn FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY u DESC, seq DESC) AS rn FROM trades) WHERE rn <= 100""",
    "price_history": _with() + """
SELECT symbol, price, ts, CAST(su // 1000 AS BIGINT) AS ms, CAST(rn AS INTEGER) AS rn FROM (
  SELECT symbol, price, ts, su, row_number() OVER (PARTITION BY symbol ORDER BY su DESC, sq DESC) AS rn
  FROM (SELECT symbol, price, ts, max(u) AS su, arg_max(seq, (u, seq)) AS sq FROM trades GROUP BY symbol, price, ts))
WHERE rn <= 100""",
    "trade_history": _with() + f"""
SELECT trade_id, symbol, price, quantity, CAST(CAST(price AS {D}) * CAST(quantity AS {D}) AS DOUBLE) AS trade_value,
       side, exchange, ts
FROM trades ORDER BY u DESC, seq DESC LIMIT 100 OFFSET 20""",
    "trade_history_far": _with() + f"""
SELECT trade_id, symbol, price, quantity, CAST(CAST(price AS {D}) * CAST(quantity AS {D}) AS DOUBLE) AS trade_value,
       side, exchange, ts
FROM trades WHERE symbol = 'SYM3' ORDER BY u DESC, seq DESC LIMIT 50 OFFSET 400""",
    "trade_counts": _with(REF, COUNTS) + "SELECT symbol, trade_count FROM counts",
    "active_views": _with(REF) + f"""
SELECT symbol, make_timestamp(last_u) AS last_trade_ts,
       ref_u - last_u < {Q.VIEW_TTL_S * 1_000_000} AS views_live,
       ref_u - last_u < {Q.COUNTER_TTL_S * 1_000_000} AS counter_live
FROM (SELECT symbol, max(u) AS last_u FROM trades GROUP BY symbol), ref""",
    "retained_trades": _with(REF) + f"""
SELECT trade_id, symbol, price, quantity, side, exchange, trader_id, ts, seq FROM trades, ref
WHERE u >= ref_u - {Q.RETENTION_S * 1_000_000}""",
    "rolling_stats": _with(ROLLING) + "SELECT * FROM stats",
    "alerts_raw": _with(ROLLING, RAW_ALERTS) + "SELECT * FROM raw_alerts",
}

KEPT = """ra AS (
  SELECT *, row_number() OVER (PARTITION BY alert_type, symbol ORDER BY u, seq) AS rn,
         CASE alert_type WHEN 'CIRCUIT_BREAKER' THEN 300000000 WHEN 'PRICE_SPIKE' THEN 60000000
                         WHEN 'VOLUME_SPIKE' THEN 30000000 ELSE 60000000 END AS cd
  FROM raw_alerts),
walk(alert_type, symbol, rn, last_kept, kept) AS (
  SELECT alert_type, symbol, rn, u AS last_kept, true AS kept FROM ra WHERE rn = 1
  UNION ALL
  SELECT n.alert_type, n.symbol, n.rn,
         CASE WHEN n.u >= w.last_kept + n.cd THEN n.u ELSE w.last_kept END,
         n.u >= w.last_kept + n.cd
  FROM walk w JOIN ra n ON n.alert_type = w.alert_type AND n.symbol = w.symbol AND n.rn = w.rn + 1),
kept AS (SELECT ra.* EXCLUDE (rn, cd) FROM ra JOIN walk USING (alert_type, symbol, rn) WHERE walk.kept),
staged AS (
  SELECT *, max(CASE WHEN alert_type = 'CIRCUIT_BREAKER' THEN u END)
              OVER (PARTITION BY symbol ORDER BY u, seq, fan ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS trip_u
  FROM kept),
final AS (
  SELECT * EXCLUDE (severity, trip_u), severity AS original_severity,
         CASE WHEN trip_u IS NULL THEN 'CLOSED' WHEN u - trip_u <= 300000000 THEN 'OPEN' ELSE 'HALF_OPEN' END
           AS breaker_state,
         CASE WHEN alert_type = 'PRICE_SPIKE' AND trip_u IS NOT NULL THEN 'CRITICAL' ELSE severity END AS severity
  FROM staged),
acks AS (
  SELECT alert_id, u + 60000000 AS req_u, 'api-user' AS acknowledged_by FROM final WHERE alert_type = 'CIRCUIT_BREAKER'
  UNION ALL
  SELECT alert_id, u + 120000000, 'desk-2' FROM final WHERE alert_type = 'CIRCUIT_BREAKER'
  UNION ALL
  SELECT alert_id, u + 60000000, 'api-user' FROM raw_alerts WHERE alert_id NOT IN (SELECT alert_id FROM final)),
ack_win AS (
  SELECT alert_id, req_u, acknowledged_by FROM (
    SELECT *, row_number() OVER (PARTITION BY alert_id ORDER BY req_u, acknowledged_by) AS r FROM acks) WHERE r = 1),
alert_table AS (
  SELECT f.*, w.alert_id IS NOT NULL AS acknowledged, make_timestamp(w.req_u) AS acknowledged_at,
         w.acknowledged_by
  FROM final f LEFT JOIN ack_win w USING (alert_id))"""

_A = _with(ROLLING, RAW_ALERTS, KEPT)
ORACLE.update({
    "alerts_kept": _A + "SELECT * FROM kept",
    "breaker_state": _A + """SELECT alert_id, symbol, triggered_at, breaker_state, severity
FROM final WHERE alert_type = 'PRICE_SPIKE'""",
    "alerts_final": _A + """SELECT alert_id, alert_type, severity, original_severity, symbol, message, triggered_at,
       trade_id, seq, fan, breaker_state, change_pct, avg_price, current_price, threshold, quantity, avg_volume,
       multiplier FROM final""",
    "alert_deliveries": _A + """SELECT alert_id, alert_type, severity, symbol, channel,
       CASE WHEN channel LIKE 'webhook%' THEN '*[' || severity || '] ' || alert_type || '*' || chr(10) || message END
         AS webhook_text,
       CASE WHEN channel LIKE 'webhook%' THEN CAST(json_object(
         'text', '*[' || severity || '] ' || alert_type || '*' || chr(10) || message,
         'alert', json_object('id', alert_id, 'type', alert_type, 'severity', severity, 'symbol', symbol,
                              'ts', strftime(triggered_at, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00')) AS VARCHAR) END AS payload
FROM final, unnest(CASE severity WHEN 'CRITICAL' THEN ['webhook_stub', 'log_critical']
                                 WHEN 'HIGH' THEN ['webhook_stub', 'log_high']
                                 WHEN 'MEDIUM' THEN ['log_medium'] ELSE ['log_low'] END) AS ch(channel)""",
    "alert_counts": _A + """SELECT CAST(grouping_id(symbol, severity) AS INTEGER) AS gid, symbol, severity,
       count(*) AS alert_count FROM final GROUP BY GROUPING SETS ((), (symbol), (severity))""",
    "recent_alerts": _A + """SELECT alert_id, alert_type, severity, symbol, message, triggered_at
FROM final ORDER BY u DESC, seq DESC, fan DESC LIMIT 100""",
    "alerts_filtered": _A + """SELECT alert_id, alert_type, severity, symbol, message, triggered_at, acknowledged
FROM alert_table WHERE symbol = 'SYM3' AND severity = 'CRITICAL' AND NOT acknowledged
ORDER BY u DESC, seq DESC, fan DESC LIMIT 50""",
    "alert_ack": _A + """SELECT a.alert_id, make_timestamp(a.req_u) AS requested_at, a.acknowledged_by,
       CASE WHEN f.alert_id IS NOT NULL AND w.req_u = a.req_u AND w.acknowledged_by = a.acknowledged_by
            THEN 'acknowledged' ELSE 'not_found' END AS status
FROM acks a JOIN ack_win w USING (alert_id) LEFT JOIN final f USING (alert_id)""",
    "whales": _A + """SELECT alert_id, symbol, triggered_at, quantity, avg_volume, multiplier
FROM final WHERE alert_type = 'VOLUME_SPIKE'""",
})

LATEST = """latest AS (SELECT symbol, price, ts, side FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY u DESC, seq DESC) AS rn FROM trades) WHERE rn = 1)"""
RECENT = """recent AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY u DESC, seq DESC) AS rn FROM trades) WHERE rn <= 100)"""
CLOSED = """closed AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol, window_seconds ORDER BY window_start DESC) AS rn FROM candles)
  WHERE rn = 2)"""
PRESSURE = f"""pressure AS (
  SELECT symbol, CAST(buy_d AS DOUBLE) AS buy_volume, CAST(sell_d AS DOUBLE) AS sell_volume,
         CASE WHEN buy_d + sell_d <> 0 THEN CAST(buy_d AS DOUBLE) / CAST(buy_d + sell_d AS DOUBLE) * 100 ELSE 50.0 END
           AS buy_pct,
         CASE WHEN buy_d + sell_d <> 0 THEN CAST(sell_d AS DOUBLE) / CAST(buy_d + sell_d AS DOUBLE) * 100 ELSE 50.0 END
           AS sell_pct,
         buy_count, sell_count
  FROM (SELECT symbol,
               sum(CASE WHEN side = 'BUY' THEN CAST(quantity AS {D}) ELSE 0 END) AS buy_d,
               sum(CASE WHEN side <> 'BUY' THEN CAST(quantity AS {D}) ELSE 0 END) AS sell_d,
               CAST(sum(CASE WHEN side = 'BUY' THEN 1 ELSE 0 END) AS BIGINT) AS buy_count,
               CAST(sum(CASE WHEN side <> 'BUY' THEN 1 ELSE 0 END) AS BIGINT) AS sell_count
        FROM recent GROUP BY symbol))"""
MOVERS = """movers AS (
  SELECT * EXCLUDE (change), round(change, 4) + 0.0 AS change_pct, CASE WHEN change >= 0 THEN 'up' ELSE 'down' END AS direction,
         CASE WHEN round(change, 4) >= 0 THEN 'gainers' ELSE 'losers' END AS side
  FROM (SELECT l.symbol, l.price, c.open_price AS open, c.total_volume AS volume, c.vwap,
               CASE WHEN c.open_price <> 0 THEN (l.price - c.open_price) / c.open_price * 100 ELSE 0.0 END AS change
        FROM latest l JOIN closed c ON c.symbol = l.symbol AND c.window_seconds = 300))"""
_LB = ", ".join(str(x) for x in [0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0])
HIST = f"""hist AS (
  SELECT le, (SELECT count(*) FROM trades WHERE latency_us / 1e6 <= le) AS cumulative_count
  FROM (SELECT unnest([{_LB}, 'inf'::DOUBLE]) AS le))"""

_M = _with(ALL_CANDLES, LATEST, RECENT, CLOSED, REF, COUNTS, PRESSURE)
ORACLE.update({
    "pressure": _M + "SELECT * FROM pressure",
    "top_movers": _with(ALL_CANDLES, LATEST, CLOSED, MOVERS) + """
SELECT side, CAST(rank AS INTEGER) AS rank, symbol, price, open, change_pct, direction, volume, vwap FROM (
  SELECT *, row_number() OVER (PARTITION BY side ORDER BY abs(change_pct) DESC, symbol) AS rank FROM movers)
WHERE rank <= 5""",
    "market_summary": _with(ALL_CANDLES, LATEST, CLOSED, REF, COUNTS, ROLLING, RAW_ALERTS, KEPT) + """
SELECT * FROM (
  SELECT count(*) AS active_symbols, CAST(sum(coalesce(n.trade_count, 0)) AS BIGINT) AS total_trades,
         CAST(round(sum(coalesce(CAST(c.total_volume AS DECIMAL(24,6)), 0)), 2) AS DOUBLE) AS total_volume_1m
  FROM latest l LEFT JOIN counts n USING (symbol)
       LEFT JOIN (SELECT * FROM closed WHERE window_seconds = 60) c USING (symbol)),
  (SELECT count(*) AS total_alerts,
          CAST(sum(CASE WHEN severity = 'CRITICAL' THEN 1 ELSE 0 END) AS BIGINT) AS critical_alerts,
          CAST(sum(CASE WHEN severity = 'HIGH' THEN 1 ELSE 0 END) AS BIGINT) AS high_alerts FROM final)""",
    "symbol_stats": _M + """
SELECT l.symbol, l.price, CAST(coalesce(n.trade_count, 0) AS BIGINT) AS daily_trades, c.vwap AS vwap_1m,
       c.total_volume AS volume_1m
FROM latest l LEFT JOIN counts n USING (symbol) LEFT JOIN (SELECT * FROM closed WHERE window_seconds = 60) c USING (symbol)""",
    "scanner": _M + """
SELECT l.symbol, l.price, c.open_price AS open_5m,
       CASE WHEN c.open_price IS NOT NULL THEN
         CASE WHEN c.open_price <> 0 THEN (l.price - c.open_price) / c.open_price * 100 ELSE 0.0 END END AS change_pct,
       c.vwap AS vwap_5m, c.total_volume AS volume_5m, p.buy_pct,
       CASE WHEN p.buy_pct >= 60.0 THEN 'BUY' WHEN p.buy_pct <= 40.0 THEN 'SELL' ELSE 'NEUTRAL' END AS signal
FROM latest l LEFT JOIN (SELECT * FROM closed WHERE window_seconds = 300) c USING (symbol)
     LEFT JOIN pressure p USING (symbol)""",
    "watchlist": _with(LATEST) + f"""
SELECT ins.asset_class, l.symbol, ins.instrument, ins.exchange, l.price, l.ts
FROM latest l JOIN {instruments_sql()} ON ins.symbol = l.symbol""",
    "price_levels": _with(LATEST, RECENT) + f"""
, mid AS (SELECT symbol, price AS mid, price * 1e-4 AS tick FROM latest),
ladder AS (SELECT symbol, mid, tick, book_side, level FROM mid, (VALUES ('bid'), ('ask')) s(book_side),
           (SELECT CAST(unnest(range(1, 11)) AS INTEGER) AS level)),
binned AS (
  SELECT r.symbol, CASE WHEN r.price < m.mid THEN 'bid' ELSE 'ask' END AS book_side,
         CAST(ceil(abs(r.price - m.mid) / m.tick) AS INTEGER) AS level, sum(CAST(r.quantity AS {D})) AS q
  FROM recent r JOIN mid m USING (symbol)
  WHERE abs(r.price - m.mid) > 0 AND ceil(abs(r.price - m.mid) / m.tick) <= 10
  GROUP BY ALL)
SELECT symbol, mid, round(tick * 2, 8) AS spread, book_side, level, price, quantity, round(price * quantity, 4) AS total
FROM (SELECT *, round(CASE WHEN book_side = 'bid' THEN mid - tick * level ELSE mid + tick * level END, 6) AS price,
             CAST(coalesce(q, 0) AS DOUBLE) AS quantity
      FROM ladder LEFT JOIN binned USING (symbol, book_side, level))""",
    "trade_rate_1m": _with() + """
SELECT make_timestamp((u // 60000000) * 60000000) AS window_start, symbol, count(*) AS trades,
       count(*) / 60.0 AS rate_per_sec FROM trades GROUP BY ALL""",
    "alert_rate_1m": _A + """
SELECT make_timestamp(r.w) AS window_start, r.received, CAST(coalesce(a.accepted, 0) AS BIGINT) AS accepted,
       CAST(r.received - coalesce(a.accepted, 0) AS BIGINT) AS suppressed
FROM (SELECT (u // 60000000) * 60000000 AS w, count(*) AS received FROM raw_alerts GROUP BY 1) r
LEFT JOIN (SELECT (u // 60000000) * 60000000 AS w, count(*) AS accepted FROM final GROUP BY 1) a USING (w)""",
    "alert_increase_1h": _with(ROLLING, RAW_ALERTS, REF) + """
SELECT alert_type, severity, count(*) AS increase FROM raw_alerts, ref
WHERE u > ref_u - 3600000000 AND u <= ref_u GROUP BY ALL""",
    "label_counters": _with(ROLLING, RAW_ALERTS, KEPT, ALL_CANDLES, FINISHED) + """
SELECT 'trades_by_symbol' AS counter, symbol AS label, count(*) AS value FROM trades GROUP BY ALL
UNION ALL SELECT 'trades_by_symbol_side', symbol || ':' || side, count(*) FROM trades GROUP BY ALL
UNION ALL SELECT 'alerts_generated', alert_type || ':' || severity, count(*) FROM raw_alerts GROUP BY ALL
UNION ALL SELECT 'alerts_received', alert_type, count(*) FROM raw_alerts GROUP BY ALL
UNION ALL SELECT 'alerts_suppressed', alert_type, count(*) FROM raw_alerts
          WHERE alert_id NOT IN (SELECT alert_id FROM final) GROUP BY ALL
UNION ALL SELECT 'alerts_delivered', channel, count(*) FROM final, unnest(CASE severity
            WHEN 'CRITICAL' THEN ['webhook_stub', 'log_critical'] WHEN 'HIGH' THEN ['webhook_stub', 'log_high']
            WHEN 'MEDIUM' THEN ['log_medium'] ELSE ['log_low'] END) AS ch(channel) GROUP BY ALL
UNION ALL SELECT 'rows_written', 'trades', count(*) FROM trades
UNION ALL SELECT 'rows_written', 'trade_aggregates', count(*) FROM finished""",
    "dedup_rate": _A + """
SELECT r.alert_type, r.received, CAST(coalesce(k.kept, 0) AS BIGINT) AS kept,
       r.received - coalesce(k.kept, 0) AS suppressed,
       (r.received - coalesce(k.kept, 0)) / r.received AS suppressed_ratio
FROM (SELECT alert_type, count(*) AS received FROM raw_alerts GROUP BY 1) r
LEFT JOIN (SELECT alert_type, count(*) AS kept FROM final GROUP BY 1) k USING (alert_type)""",
    "gauges": _A + """
SELECT count(DISTINCT symbol) AS active_symbols, count(DISTINCT symbol) * 3 AS open_windows,
       (SELECT count(DISTINCT symbol) FROM final WHERE alert_type = 'CIRCUIT_BREAKER') AS open_breakers,
       count(*) AS trades_total FROM trades""",
    "latency_histogram": _with(HIST) + "SELECT le, cumulative_count FROM hist",
})

ORACLE["latency_quantiles"] = _with(HIST) + """
, hb AS (SELECT le, cumulative_count AS c, lag(le, 1, 0.0) OVER (ORDER BY le) AS lo,
                lag(cumulative_count, 1, 0) OVER (ORDER BY le) AS c_lo FROM hist WHERE le < 'inf'::DOUBLE),
tot AS (SELECT count(*) AS n FROM trades),
qs AS (SELECT CAST(unnest([0.5, 0.95, 0.99]) AS DOUBLE) AS quantile)
SELECT quantile, coalesce((SELECT lo + (le - lo) * (quantile * n - c_lo) / (c - c_lo) FROM hb
                           WHERE c >= quantile * n ORDER BY le LIMIT 1), 1.0) AS latency_s
FROM qs, tot"""

ISO = "strftime({c}, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'"
_FAULT = "CASE seq % 101 WHEN 7 THEN 'malformed' WHEN 17 THEN 'missing_key' WHEN 27 THEN 'extra_key' " \
         "WHEN 37 THEN 'bad_type' WHEN 47 THEN 'bad_side' END"
ORACLE.update({
    "trades_clean": _with() + f"""
SELECT trade_id, symbol, price, quantity,
       CAST(CAST(CAST(price AS {D}) * CAST(quantity AS {D}) AS DECIMAL(24,6)) AS DOUBLE) AS trade_value,
       side, exchange, trader_id, ts, seq, latency_us
FROM trades WHERE {_FAULT} IS NULL""",
    "quarantine": _with() + f"""
SELECT seq AS offset, {_FAULT} AS reason FROM trades WHERE {_FAULT} IS NOT NULL
UNION ALL
SELECT seq + 1000000000000, {_FAULT} FROM trades WHERE {_FAULT} IS NOT NULL AND seq % 23 = 0""",
    "trade_messages": _with() + f"""
SELECT symbol AS key, trade_id, symbol, price, quantity, side, exchange, trader_id,
       {ISO.format(c='ts')} AS timestamp, seq AS sequence, 'application/json' AS content_type FROM trades""",
    "alert_messages": _A + """
SELECT symbol AS key, NULL::VARCHAR AS reason, alert_id, alert_type, severity, symbol, message, triggered_at,
       change_pct, avg_price, current_price, threshold, quantity, avg_volume, multiplier FROM final""",
    "candle_messages": _with(ALL_CANDLES, FINISHED) + f"""
SELECT symbol AS key, symbol, window_seconds AS window_sec, {ISO.format(c='window_start')} AS window_start,
       open_price AS open, high_price AS high, low_price AS low, close_price AS close, total_volume AS volume,
       vwap, trade_count AS trades FROM finished""",
    "channel_envelopes": _with(ROLLING, RAW_ALERTS, KEPT, ALL_CANDLES, FINISHED) + f"""
SELECT 'alerts' AS type, symbol AS key, symbol AS data_symbol, alert_id AS item FROM final
UNION ALL
SELECT 'aggregates', symbol, symbol, CAST(window_seconds AS VARCHAR) || '@' || {ISO.format(c='window_start')}
FROM finished""",
    "export_csv": _with() + """
SELECT trade_id, symbol, price, quantity, side, exchange, ts FROM trades ORDER BY u DESC, seq DESC LIMIT 500""",
})

# views of the streams lose what lies before an hour of silence
ALIVE = """gaps AS (
  SELECT *, CASE WHEN u - lag(u) OVER (PARTITION BY symbol ORDER BY u, seq) >= 3600000000 THEN 1 ELSE 0 END AS gap FROM trades),
runs AS (SELECT *, sum(gap) OVER (PARTITION BY symbol ORDER BY u, seq) AS run FROM gaps),
alive AS (SELECT r.* FROM runs r JOIN (SELECT symbol, max(run) AS run, max(u) AS last_u FROM runs GROUP BY symbol) m USING (symbol, run), ref
          WHERE ref_u - m.last_u < 3600000000)"""


def _alive(query: str) -> str:
    body = ORACLE[query][len(_with()):]
    return _with(REF, ALIVE) + body.replace("FROM trades", "FROM alive")


ORACLE.update({
    "stream_candles": _with(ALL_CANDLES, REF) + f"""
SELECT {CANDLE_COLS} FROM candles, ref WHERE ws_u + window_seconds * 1000000 <= ref_u - 10000000""",
    "stream_candles_upsert": ORACLE["ohlcv_all"],
    "stream_detect": ORACLE["alerts_raw"],
    "stream_alerts": _A + """SELECT alert_id, alert_type, severity, symbol, message, trade_id, u, seq, fan, change_pct,
       avg_price, current_price, threshold, quantity, avg_volume, multiplier, original_severity, breaker_state,
       triggered_at FROM final""",
    "stream_prices": _alive("latest_price"),
    "stream_trades_sink": ORACLE["trades_clean"],
    "stream_last_candles": _with(ALL_CANDLES, REF) + f"""
SELECT {CANDLE_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol, window_seconds ORDER BY window_start DESC) AS rn
  FROM candles, ref WHERE ws_u + window_seconds * 1000000 <= ref_u - 10000000) WHERE rn = 1""",
    "stream_recent_trades": _alive("recent_trades"),
    "stream_price_history": _alive("price_history"),
    "stream_trade_counts": ORACLE["trade_counts"],
    "stream_alert_counts": ORACLE["alert_counts"],
    "stream_counters": _with(ROLLING, RAW_ALERTS, KEPT) + f"""
SELECT 'trades_by_symbol' AS counter, symbol AS label, count(*) AS value FROM trades GROUP BY ALL
UNION ALL SELECT 'trades_by_symbol_side', symbol || ':' || side, count(*) FROM trades GROUP BY ALL
UNION ALL SELECT 'alerts_generated', alert_type || ':' || severity, count(*) FROM raw_alerts GROUP BY ALL
UNION ALL SELECT 'alerts_received', alert_type, count(*) FROM raw_alerts GROUP BY ALL
UNION ALL SELECT 'alerts_suppressed', alert_type, count(*) FROM raw_alerts
          WHERE alert_id NOT IN (SELECT alert_id FROM final) GROUP BY ALL
UNION ALL SELECT 'alerts_delivered', channel, count(*) FROM final, unnest(CASE severity
            WHEN 'CRITICAL' THEN ['webhook_stub', 'log_critical'] WHEN 'HIGH' THEN ['webhook_stub', 'log_high']
            WHEN 'MEDIUM' THEN ['log_medium'] ELSE ['log_low'] END) AS ch(channel) GROUP BY ALL
UNION ALL SELECT 'rows_written', 'trades', count(*) FROM trades WHERE {_FAULT} IS NULL
UNION ALL SELECT 'messages_rejected', reason, count(*) FROM (
          SELECT {_FAULT} AS reason FROM trades UNION ALL SELECT {_FAULT} FROM trades WHERE seq % 23 = 0)
          WHERE reason IS NOT NULL GROUP BY ALL""",
})

ORACLE.update({
    "latest_price_of": f"SELECT * FROM ({ORACLE['latest_price']}) WHERE symbol IN ('SYM3', 'SYM7')",
    "recent_trades_of": f"SELECT * FROM ({ORACLE['recent_trades']}) WHERE symbol = 'SYM5' AND rn <= 20",
    "trade_rate_by_side": _with() + """
SELECT make_timestamp((u // 60000000) * 60000000) AS window_start, symbol, side, count(*) AS trades,
       count(*) / 60.0 AS rate_per_sec FROM trades GROUP BY ALL""",
    "alert_rate_by_severity": _with(ROLLING, RAW_ALERTS) + """
SELECT make_timestamp((u // 60000000) * 60000000) AS window_start, alert_type, severity, count(*) AS alerts,
       count(*) / 60.0 AS rate_per_sec FROM raw_alerts GROUP BY ALL""",
    "write_rate_by_table": _with(ALL_CANDLES, FINISHED) + """
SELECT make_timestamp((u // 60000000) * 60000000) AS window_start, "table", count(*) AS rows, count(*) / 60.0 AS rate_per_sec
FROM (SELECT 'trades' AS "table", u FROM trades
      UNION ALL SELECT 'trade_aggregates', ws_u + window_seconds * 1000000 FROM finished) GROUP BY ALL""",
    "trade_rate_sliding": _with() + """
SELECT make_timestamp(w) AS window_start, make_timestamp(w + 60000000) AS window_end, symbol, count(*) AS trades,
       count(*) / 60.0 AS rate_per_sec
FROM (SELECT symbol, (u // 5000000) * 5000000 - k * 5000000 AS w
      FROM trades, (SELECT unnest(range(12)) AS k)) GROUP BY w, symbol""",
    "quarantine_counts": _with() + f"""
SELECT reason, count(*) AS messages FROM (
  SELECT {_FAULT} AS reason FROM trades
  UNION ALL SELECT {_FAULT} FROM trades WHERE seq % 23 = 0) WHERE reason IS NOT NULL GROUP BY reason""",
})


_ALERT_FAULT = "CASE seq % 101 WHEN 7 THEN 'missing_key' WHEN 17 THEN 'missing_key' WHEN 37 THEN 'bad_severity' WHEN 47 THEN 'too_long' END"
ORACLE.update({
    "stream_envelopes": ORACLE["channel_envelopes"],
    "alert_quarantine": _with(ROLLING, RAW_ALERTS) + f"""
SELECT alert_id AS sent_id, {_ALERT_FAULT} AS reason FROM raw_alerts WHERE {_ALERT_FAULT} IS NOT NULL""",
    "alerts_accepted": _with(ROLLING, RAW_ALERTS) + f"""
SELECT alert_id, alert_type, severity, symbol, message, triggered_at, u FROM raw_alerts WHERE {_ALERT_FAULT} IS NULL""",
    "retained_trades_table": _with() + f"""
, moved AS (SELECT trade_id, symbol, price, quantity, side, ts - to_days(CAST(seq % 10 AS INTEGER)) AS ts, seq FROM trades)
SELECT * FROM moved WHERE ts >= (SELECT max(ts) FROM moved) - to_days({Q.SQ.RETAINED_S // 86_400})""",
})
