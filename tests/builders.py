"""Hand-made inputs for unit tests (every trade gets its own id and sequence,
unlike the reference's builder, because trades are deduplicated by id and
ordered by (ts, sequence))."""
from __future__ import annotations

from pyspark.sql import functions as F

from candlewick.functions.timecols import ntz_from_micros

BASE_US = 1_704_103_200_000_000  # 2024-01-01T10:00:00Z


def trades(spark, rows):
    """rows: (symbol, price, quantity, side, seconds_after_base)."""
    data = [(str(i), s, float(p), float(q), side, "NASDAQ", "trader_001", BASE_US + int(t * 1_000_000), i, 100)
            for i, (s, p, q, side, t) in enumerate(rows)]
    df = spark.createDataFrame(data, "trade_id string, symbol string, price double, quantity double, side string, "
                                     "exchange string, trader_id string, u long, seq long, latency_us int")
    return df.withColumn("ts", ntz_from_micros("u"))


def alerts(spark, rows):
    """rows: (alert_type, symbol, seconds_after_base[, severity])."""
    sev = {"CIRCUIT_BREAKER": "CRITICAL", "PRICE_SPIKE": "HIGH", "VOLUME_SPIKE": "MEDIUM"}
    data = []
    for i, r in enumerate(rows):
        kind, sym, t = r[:3]
        data.append((f"a{i}", kind, r[3] if len(r) > 3 else sev.get(kind, "LOW"), sym, f"Test alert for {sym}",
                     str(i), BASE_US + int(t * 1_000_000), i, 0))
    df = spark.createDataFrame(data, "alert_id string, alert_type string, severity string, symbol string, "
                                     "message string, trade_id string, u long, seq long, fan int")
    return df.withColumn("triggered_at", ntz_from_micros("u"))


def ids(df, col="alert_id"):
    return sorted(r[0] for r in df.select(col).collect())


def col(df, name):
    return [r[0] for r in df.orderBy("u", "seq").select(name).collect()] if "u" in df.columns else \
        [r[0] for r in df.select(name).collect()]


__all__ = ["trades", "alerts", "ids", "col", "F", "BASE_US"]
