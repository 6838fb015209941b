"""Message decoders (S4, S5, F6, D17) and the fixture message stream.

``decode_trades`` is strict: the JSON object must have exactly the ten trade
keys; values must convert; side and required fields are checked. Every
rejected message lands in the quarantine with a reason instead of being
dropped silently. ``decode_alerts`` is lenient: six required keys, optional
``details``, extra keys ignored. Both are pure column expressions (no UDF),
so they run inside whole-stage codegen on batch or streaming input.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.functions.timecols import ntz_from_micros

# The wire keys of a trade message, in declaration order
TRADE_KEYS = ["trade_id", "symbol", "price", "quantity", "side", "exchange", "trader_id", "timestamp", "sequence",
              "metadata"]
SIDES = ["BUY", "SELL"]
ALERT_REQUIRED = ["alert_id", "alert_type", "severity", "symbol", "message", "triggered_at"]

METADATA_TYPE = T.StructType([T.StructField("source", T.StringType()), T.StructField("latency_us", T.IntegerType())])
TRADE_WIRE = T.StructType([
    T.StructField("trade_id", T.StringType()), T.StructField("symbol", T.StringType()),
    T.StructField("price", T.DoubleType()), T.StructField("quantity", T.DoubleType()),
    T.StructField("side", T.StringType()), T.StructField("exchange", T.StringType()),
    T.StructField("trader_id", T.StringType()), T.StructField("timestamp", T.StringType()),
    T.StructField("sequence", T.LongType()), T.StructField("metadata", METADATA_TYPE),
])
DETAILS_TYPE = T.StructType([T.StructField(n, T.DoubleType()) for n in
                             ("change_pct", "avg_price", "current_price", "threshold", "quantity", "avg_volume",
                              "multiplier")])
ALERT_WIRE = T.StructType([
    T.StructField("alert_id", T.StringType()), T.StructField("alert_type", T.StringType()),
    T.StructField("severity", T.StringType()), T.StructField("symbol", T.StringType()),
    T.StructField("message", T.StringType()), T.StructField("details", DETAILS_TYPE),
    T.StructField("triggered_at", T.StringType()),
])

SEVERITIES = ["LOW", "MEDIUM", "HIGH", "CRITICAL"]
REASONS = ["malformed", "missing_key", "extra_key", "bad_type", "bad_side", "too_long", "out_of_range"]
# Text lengths of the tables, and the whole digits of their amounts (18 and 24 digits, six after the point)
TRADE_LENGTHS = {"symbol": 20, "exchange": 20, "trader_id": 50}
ALERT_LENGTHS = {"alert_type": 50, "symbol": 20}
AMOUNT_DIGITS, VALUE_DIGITS = 12, 18


def iso_utc(ts_ntz: F.Column) -> F.Column:
    """ISO-8601 text with an explicit UTC offset for a timestamp_ntz."""
    return F.concat(F.date_format(ts_ntz, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


def _too_long(limits: dict[str, int], of) -> F.Column:
    out = F.lit(False)
    for name, n in limits.items():
        out = out | F.coalesce(F.length(of(name)) > n, F.lit(False))
    return out


def _fits(x: F.Column, digits: int) -> F.Column:
    """Whether a double goes into that many whole digits; NaN and infinities do not."""
    return F.abs(x) < 10.0 ** digits


def _micros_of_iso(s: F.Column) -> F.Column:
    """Epoch microseconds of ISO text (offset honoured; NULL if unparsable)."""
    return F.unix_micros(F.try_to_timestamp(s))


def decode_trades(raw: DataFrame, value: str = "value") -> DataFrame:
    """S4 + F6: returns the input with ``reason`` (NULL = valid) and, for
    valid rows, the decoded trade columns (``u`` epoch micros, ``ts``).
    Amounts that the tables' decimals cannot hold, or texts that their columns
    cannot, are a reason like any other, so no later cast overflows.

    The decoded record comes out of a one-row ``inline`` generator: filters on
    ``reason`` then stay above it instead of being pushed into the scan with
    the whole parse inlined (which would re-run the JSON parser per use)."""
    v = F.col(value)
    expected = F.array(*[F.lit(k) for k in TRADE_KEYS])
    # parse once (a projection), then build the record from the parsed columns
    d = raw.withColumn("__p", F.from_json(v, TRADE_WIRE)).withColumn("__keys", F.json_object_keys(v))
    d = d.withColumn("__u", _micros_of_iso(F.col("__p.timestamp")))
    p, keys, u = F.col("__p"), F.col("__keys"), F.col("__u")
    required = ["trade_id", "symbol", "price", "quantity", "side", "exchange", "timestamp", "sequence"]
    any_null = F.lit(False)
    for r in required:
        any_null = any_null | p[r].isNull()
    reason = (F.when(keys.isNull(), "malformed")
              .when(F.size(F.array_except(expected, keys)) > 0, "missing_key")
              .when(F.size(F.array_except(keys, expected)) > 0, "extra_key")
              .when(any_null | u.isNull(), "bad_type")
              .when(~p["side"].isin(SIDES), "bad_side")
              .when(_too_long(TRADE_LENGTHS, lambda c: p[c]), "too_long")
              .when(~(_fits(p["price"], AMOUNT_DIGITS) & _fits(p["quantity"], AMOUNT_DIGITS)
                      & _fits(p["price"] * p["quantity"], VALUE_DIGITS)), "out_of_range"))
    rec = F.struct(
        reason.alias("reason"), p["trade_id"].alias("trade_id"), p["symbol"].alias("symbol"),
        p["price"].alias("price"), p["quantity"].alias("quantity"), p["side"].alias("side"),
        p["exchange"].alias("exchange"), p["trader_id"].alias("trader_id"), u.alias("u"),
        ntz_from_micros(u).alias("ts"), p["sequence"].alias("seq"), p["metadata"]["latency_us"].alias("latency_us"))
    return d.select(*raw.columns, F.inline(F.array(rec)))


DECODED_TRADE = ["trade_id", "symbol", "price", "quantity", "side", "exchange", "trader_id", "u", "ts", "seq",
                 "latency_us"]


def valid_trades(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("reason").isNull()).select(*DECODED_TRADE)


def quarantine(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("reason").isNotNull())


def dedup_trades(trades: DataFrame) -> DataFrame:
    """X9 / D2 (batch): one row per trade_id, the earliest by (u, seq).
    ``min_by`` aggregates partially before the shuffle (no sort)."""
    cols = [c for c in trades.columns if c != "trade_id"]
    g = trades.groupBy("trade_id").agg(F.min_by(F.struct(*cols), F.struct("u", "seq")).alias("r"))
    return g.select("trade_id", "r.*")


def _alert_reason(complete: F.Column) -> F.Column:
    p = F.col("__p")
    return (F.when(~complete, "missing_key").when(~p["severity"].isin(SEVERITIES), "bad_severity")
            .when(_too_long(ALERT_LENGTHS, lambda c: p[c]), "too_long"))


def decode_alerts(raw: DataFrame, value: str = "value") -> DataFrame:
    """S5 + F6: lenient alert decode; ``reason`` is ``missing_key`` when a required
    key is absent or the message is not a JSON object, ``bad_severity`` or
    ``too_long`` when the alert table does not take the row."""
    p = F.from_json(F.col(value), ALERT_WIRE)
    ok = F.lit(True)
    for r in ALERT_REQUIRED:
        ok = ok & F.col(f"__p.{r}").isNotNull()
    d = raw.withColumn("__p", p)
    u = _micros_of_iso(F.col("__p.triggered_at"))
    return d.select(
        *raw.columns, _alert_reason(F.coalesce(ok, F.lit(False))).alias("reason"),
        *[F.col(f"__p.{r}").alias(r) for r in ALERT_REQUIRED if r != "triggered_at"],
        ntz_from_micros(u).alias("triggered_at"), u.alias("u"),
        F.coalesce(F.col("__p.details"), F.struct(*[F.lit(None).cast("double").alias(f.name)
                                                   for f in DETAILS_TYPE.fields])).alias("details"),
    )


def trade_json(trades: DataFrame) -> F.Column:
    """K3: the trade message body (the ten wire keys)."""
    return F.to_json(F.struct(
        "trade_id", "symbol", "price", "quantity", "side", "exchange", "trader_id",
        iso_utc(F.col("ts")).alias("timestamp"), F.col("seq").alias("sequence"),
        F.struct(F.lit("fixture").alias("source"), F.col("latency_us").alias("latency_us")).alias("metadata")),
        KEEP_NULLS)


KEEP_NULLS = {"ignoreNullFields": "false"}  # a null trader_id is sent as "trader_id": null

# Fault injection for the fixture stream: which message (by sequence number
# modulo FAULT_MOD) gets which defect; every row is still emitted.
FAULT_MOD = 101
FAULTS = {7: "malformed", 17: "missing_key", 27: "extra_key", 37: "bad_type", 47: "bad_side"}
DUPLICATE_MOD = 23  # every 23rd message is delivered twice
DUPLICATE_OFFSET = 10 ** 12  # offset of the redelivered copy


def fixture_messages(trades: DataFrame) -> DataFrame:
    """The trade topic as (offset, key, value) built from the trades relation,
    with defective and redelivered messages mixed in (one shape each)."""
    meta = F.struct(F.lit("fixture").alias("source"), F.col("latency_us").alias("latency_us")).alias("metadata")
    base = ["trade_id", "symbol", "price", "quantity", "side", "exchange", "trader_id"]
    iso = iso_utc(F.col("ts")).alias("timestamp")
    js = lambda *cols: F.to_json(F.struct(*cols), KEEP_NULLS)
    seq = F.col("seq").alias("sequence")
    good = js(*base, iso, seq, meta)
    missing = js(*[c for c in base if c != "exchange"], iso, seq, meta)
    extra = js(*base, iso, seq, meta, F.lit("X").alias("venue"))
    bad_type = js("trade_id", "symbol", F.lit("abc").alias("price"), *base[3:], iso, seq, meta)
    bad_side = js(*base[:4], F.lit("HOLD").alias("side"), *base[5:], iso, seq, meta)
    n = F.col("seq") % FAULT_MOD
    value = (F.when(n == 7, F.expr("substring(__g, 1, length(__g) - 5)"))
             .when(n == 17, missing).when(n == 27, extra).when(n == 37, bad_type).when(n == 47, bad_side)
             .otherwise(good))
    m = trades.withColumn("__g", good).select(F.col("seq").alias("offset"), F.col("symbol").alias("key"),
                                               value.alias("value"), F.col("seq").alias("__seq"))
    dup = m.filter(F.col("__seq") % DUPLICATE_MOD == 0).withColumn("offset", F.col("offset") + DUPLICATE_OFFSET)
    return m.unionByName(dup).drop("__seq")


def fixture_alert_messages(alerts: DataFrame) -> DataFrame:
    """The alert topic as (offset, key, value), each alert's trade number being its offset, with defects mixed in by the
    rule of ``fixture_messages``: a cut message, a missing key, an extra key (which is no defect here), a severity and a
    symbol that the alert table does not take."""
    iso = iso_utc(F.col("triggered_at")).alias("triggered_at")
    js = lambda *cols: F.to_json(F.struct(*cols, iso))
    head, mid, tail = ["alert_id", "alert_type"], F.col("severity"), ["symbol", "message"]
    good = js(*head, mid, *tail)
    n = F.col("seq") % FAULT_MOD
    value = (F.when(n == 7, F.expr("substring(__g, 1, length(__g) - 5)"))
             .when(n == 17, js(*head, mid, "message")).when(n == 27, js(*head, mid, *tail, F.lit(1).alias("extra")))
             .when(n == 37, js(*head, F.lit("SEVERE").alias("severity"), *tail))
             .when(n == 47, js(*head, mid, F.repeat(F.col("symbol"), F.lit(11)).alias("symbol"), "message"))
             .otherwise(good))
    return alerts.withColumn("__g", good).select(F.col("seq").alias("offset"), F.col("symbol").alias("key"), value.alias("value"),
                                                 F.col("alert_id").alias("sent_id"))
