"""Anomaly detection (W1, W2, D-PS, D-CB, D-VS, D-FAN).

The baseline of a trade is the mean price / quantity of the previous <=100
trades of its symbol (current excluded), NULL with fewer than 5. Computed as
a decimal sum over a rank frame: ``ordinal_rank`` + ``rolling_previous`` keep
every task bounded even when one symbol carries a third of all trades.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.functions.numeric import dec
from candlewick.functions.text import alert_message
from candlewick.functions.ordered import TRADE_BUCKET_US, ordinal_rank, rolling_previous

# Fixed detector defaults
LOOKBACK = 100
MIN_PRIOR = 5
PRICE_SPIKE = 0.05
CIRCUIT_BREAKER = 0.10
VOLUME_MULTIPLIER = 3.0

ALERT_COLUMNS = [
    "alert_id", "alert_type", "severity", "symbol", "message", "triggered_at", "trade_id", "u", "seq", "fan",
    "change_pct", "avg_price", "current_price", "threshold", "quantity", "avg_volume", "multiplier",
]


def rolling_stats(trades: DataFrame, lookback: int = LOOKBACK, min_prior: int = MIN_PRIOR,
                  bucket_us: int = TRADE_BUCKET_US, chunk_rows: int = 200_000) -> DataFrame:
    """Per trade, ``n_prior`` and the mean price / quantity of the
    previous ``lookback`` trades of the symbol (NULL below ``min_prior``)."""
    t = trades.select("trade_id", "symbol", "price", "quantity", "side", "ts", "u", "seq")
    t = ordinal_rank(t, "symbol", bucket_us=bucket_us)
    t = rolling_previous(
        t, "symbol",
        {"__sp": dec("price"), "__sq": dec("quantity")},
        n=lookback, chunk_rows=chunk_rows,
    )
    enough = F.col("n_prior") >= min_prior
    return t.select(
        "trade_id", "symbol", "price", "quantity", "side", "ts", "u", "seq",
        F.col("n_prior").cast("int").alias("n_prior"),
        F.when(enough, F.col("__sp").cast("double") / F.col("n_prior")).alias("avg_price"),
        F.when(enough, F.col("__sq").cast("double") / F.col("n_prior")).alias("avg_volume"),
    )


def alerts_from_stats(stats: DataFrame, price_spike: float = PRICE_SPIKE, circuit_breaker: float = CIRCUIT_BREAKER,
                      volume_multiplier: float = VOLUME_MULTIPLIER) -> DataFrame:
    """D-PS / D-CB / D-VS / D-FAN: 0-2 alerts per trade, price alert first.

    One pass: both candidate alerts are built as structs, the non-null ones
    exploded (``fan`` 0 = price, 1 = volume)."""
    avg_p, avg_v = F.col("avg_price"), F.col("avg_volume")
    change = F.when(avg_p.isNotNull() & (avg_p != 0), F.abs(F.col("price") - avg_p) / avg_p)
    s = stats.select("*", change.alias("change_pct"))

    def price_alert(kind: str, sev: str, thr: float) -> F.Column:
        return F.struct(
            F.lit(kind).alias("alert_type"), F.lit(sev).alias("severity"),
            F.lit(0).alias("fan"), F.col("change_pct").alias("change_pct"), avg_p.alias("avg_price"),
            F.col("price").alias("current_price"), F.lit(thr).alias("threshold"),
            F.lit(None).cast("double").alias("quantity"), F.lit(None).cast("double").alias("avg_volume"),
            F.lit(None).cast("double").alias("multiplier"),
        )

    price_a = (F.when(F.col("change_pct") >= circuit_breaker,
                      price_alert("CIRCUIT_BREAKER", "CRITICAL", circuit_breaker))
               .when(F.col("change_pct") >= price_spike, price_alert("PRICE_SPIKE", "HIGH", price_spike)))
    mult = F.col("quantity") / avg_v
    vol_a = F.when(
        avg_v.isNotNull() & (avg_v != 0) & (F.col("quantity") > avg_v * F.lit(volume_multiplier)),
        F.struct(
            F.lit("VOLUME_SPIKE").alias("alert_type"), F.lit("MEDIUM").alias("severity"),
            F.lit(1).alias("fan"), F.lit(None).cast("double").alias("change_pct"),
            F.lit(None).cast("double").alias("avg_price"), F.lit(None).cast("double").alias("current_price"),
            F.lit(None).cast("double").alias("threshold"), F.col("quantity").alias("quantity"),
            avg_v.alias("avg_volume"), mult.alias("multiplier"),
        ),
    )
    cand = s.select("trade_id", "symbol", "price", "ts", "u", "seq",
                    F.explode(F.filter(F.array(price_a, vol_a), lambda x: x.isNotNull())).alias("a"))
    return cand.select(
        F.sha2(F.concat_ws("|", F.col("trade_id"), F.col("a.alert_type")), 256).alias("alert_id"),
        "a.alert_type", "a.severity", "symbol", F.col("ts").alias("triggered_at"),
        "trade_id", "u", "seq", "a.fan", "a.change_pct", "a.avg_price", "a.current_price", "a.threshold",
        "a.quantity", "a.avg_volume", "a.multiplier",
    )


def with_message(alerts: DataFrame) -> DataFrame:
    """Add the alert text. Done last, on the rows that are output, so
    queries that only count alerts never run the text helper."""
    from candlewick.session import ship_package
    ship_package(alerts.sparkSession)
    msg = alert_message(F.col("alert_type"), F.col("symbol"), F.col("change_pct"), F.col("avg_price"),
                        F.col("current_price"), F.col("quantity"), F.col("avg_volume"))
    return alerts.select("*", msg.alias("message"))


def alerts_raw(trades: DataFrame, **kw) -> DataFrame:
    stat_kw = {k: kw.pop(k) for k in list(kw) if k in ("lookback", "min_prior", "bucket_us", "chunk_rows")}
    return with_message(alerts_from_stats(rolling_stats(trades, **stat_kw), **kw))
