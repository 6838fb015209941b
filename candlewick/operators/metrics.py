"""Pipeline metrics as queries over the data (A9-A13): counters by label,
per-minute rates, hourly increases, gauges and the latency histogram with
bucket-interpolated quantiles. Every one is a partial-aggregating groupBy."""
from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.functions.timecols import bucket_start_micros, ntz_from_micros

# Latency histogram bucket bounds (seconds)
LATENCY_BUCKETS_S = [0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0]
QUANTILES = (0.5, 0.95, 0.99)
WINDOWS_S = (60, 300, 900)  # candle sizes


def trade_rate_1m(trades: DataFrame) -> DataFrame:
    """A10: trades per one-minute window and symbol, and the per-second rate."""
    g = trades.withColumn("w", bucket_start_micros("u", 60)).groupBy("w", "symbol").agg(
        F.count(F.lit(1)).alias("trades"))
    return g.select(ntz_from_micros("w").alias("window_start"), "symbol", "trades",
                    (F.col("trades") / F.lit(60.0)).alias("rate_per_sec"))


def trade_rate_sliding(trades: DataFrame, size_s: int = 60, slide_s: int = 5) -> DataFrame:
    """Trades per symbol over a ``size_s`` window sliding every
    ``slide_s`` (the dashboard's 1-minute rate refreshed every 5 s). Trades
    are counted per slide first; only these counts are spread over the
    size/slide windows that contain them."""
    if size_s % slide_s:
        raise ValueError("size must be a multiple of the slide")
    n = size_s // slide_s
    slide_us = slide_s * 1_000_000
    per_slide = trades.groupBy("symbol", bucket_start_micros("u", slide_s).alias("last")).agg(F.count(F.lit(1)).alias("n"))
    t = per_slide.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    t = t.withColumn("w", F.col("last") - F.col("k") * F.lit(slide_us))
    g = t.groupBy("w", "symbol").agg(F.sum("n").alias("trades"))
    return g.select(ntz_from_micros("w").alias("window_start"),
                    ntz_from_micros(F.col("w") + F.lit(size_s * 1_000_000)).alias("window_end"), "symbol", "trades",
                    (F.col("trades") / F.lit(float(size_s))).alias("rate_per_sec"))


def quarantine_counts(decoded: DataFrame) -> DataFrame:
    """A9 errors by kind: rejected messages per reason."""
    return decoded.filter(F.col("reason").isNotNull()).groupBy("reason").agg(F.count(F.lit(1)).alias("messages"))


def latency_percentiles_approx(trades: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """A12 at scale: p50/p95/p99 of the raw latency with ``percentile_approx``
    (one pass, mergeable sketches, no histogram bucketing error)."""
    lat = F.col("latency_us") / F.lit(1e6)
    return trades.agg(F.percentile_approx(lat, list(QUANTILES), accuracy).alias("p")).select(
        F.explode(F.arrays_zip(F.array(*[F.lit(q) for q in QUANTILES]).alias("quantile"), F.col("p").alias("v")))
        .alias("z")).select(F.col("z.quantile").alias("quantile"), F.col("z.v").alias("latency_s"))


SKETCH_K = 800  # size of a KLL sketch: a rank error of about 0.4 %


def latency_sketches(trades: DataFrame, width_s: int = 60, k: int = SKETCH_K) -> DataFrame:
    """A mergeable KLL sketch of the latencies of each symbol and minute (window_u, symbol, n, sketch). Stored beside
    the trades, these few kilobytes a minute answer quantiles over any window and set of symbols without reading trades."""
    w = bucket_start_micros("u", width_s).alias("window_u")
    return trades.groupBy(w, "symbol").agg(F.count("latency_us").alias("n"),
                                           F.kll_sketch_agg_bigint(F.col("latency_us").cast("long"), F.lit(k)).alias("sketch"))


def merge_sketches(sketches: DataFrame, window_s: int | None = None, labels: tuple[str, ...] = (), k: int = SKETCH_K) -> DataFrame:
    """Sketches rolled up to windows of ``window_s`` (None: all time) and to the given labels."""
    at = [bucket_start_micros("window_u", window_s).alias("window_u")] if window_s else []
    return sketches.groupBy(*at, *labels).agg(F.sum("n").alias("n"), F.kll_merge_agg_bigint("sketch", F.lit(k)).alias("sketch"))


def sketch_quantiles(sketches: DataFrame, quantiles=QUANTILES) -> DataFrame:
    """quantile, latency_s of every row of ``sketches``."""
    q = F.array(*[F.lit(float(x)) for x in quantiles])
    both = F.arrays_zip(q.alias("quantile"), F.kll_sketch_get_quantile_bigint("sketch", q).alias("v"))
    rows = sketches.where("n > 0").select(*[c for c in sketches.columns if c != "sketch"], F.explode(both).alias("z"))
    return rows.select(*[c for c in rows.columns if c != "z"], F.col("z.quantile").alias("quantile"), (F.col("z.v") / 1e6).alias("latency_s"))


def trade_rate_by_side(trades: DataFrame) -> DataFrame:
    """A10: trades per one-minute window, symbol and side, and the per-second rate."""
    g = trades.groupBy(bucket_start_micros("u", 60).alias("w"), "symbol", "side").agg(F.count(F.lit(1)).alias("trades"))
    return g.select(ntz_from_micros("w").alias("window_start"), "symbol", "side", "trades", (F.col("trades") / 60.0).alias("rate_per_sec"))


def alert_rate_by_severity(raw: DataFrame) -> DataFrame:
    """A10: generated alerts per one-minute window, type and severity, and the per-second rate."""
    g = raw.groupBy(bucket_start_micros("u", 60).alias("w"), "alert_type", "severity").agg(F.count(F.lit(1)).alias("alerts"))
    return g.select(ntz_from_micros("w").alias("window_start"), "alert_type", "severity", "alerts",
                    (F.col("alerts") / 60.0).alias("rate_per_sec"))


def write_rate_by_table(trades: DataFrame, windows: tuple[int, ...] = WINDOWS_S) -> DataFrame:
    """A10: rows written per one-minute window and table: trades by their time, finished candles by the end of their window
    (each symbol's newest window of a size is open)."""
    each = F.explode(F.array(*[F.struct(F.lit(s).alias("size"), bucket_start_micros("u", s).alias("start")) for s in windows]))
    seen = trades.select("symbol", bucket_start_micros("u", math.gcd(*windows)).alias("u")).distinct()
    seen = seen.select("symbol", each.alias("x")).select("symbol", "x.*").distinct()
    newest = seen.groupBy("symbol", "size").agg(F.max("start").alias("open"))
    done = seen.join(newest, ["symbol", "size"]).where(F.col("start") < F.col("open"))
    ends = done.select(F.lit("trade_aggregates").alias("table"), (F.col("start") + F.col("size").cast("long") * 1_000_000).alias("u"))
    rows = trades.select(F.lit("trades").alias("table"), "u").unionByName(ends)
    g = rows.groupBy(bucket_start_micros("u", 60).alias("w"), "table").agg(F.count(F.lit(1)).alias("rows"))
    return g.select(ntz_from_micros("w").alias("window_start"), "table", "rows", (F.col("rows") / 60.0).alias("rate_per_sec"))


def alert_rate_1m(raw: DataFrame, final: DataFrame) -> DataFrame:
    """A10: alerts received, accepted and suppressed per minute
    (alerts/min = rate * 60)."""
    rec = raw.withColumn("w", bucket_start_micros("u", 60)).groupBy("w").agg(F.count(F.lit(1)).alias("received"))
    acc = final.withColumn("w", bucket_start_micros("u", 60)).groupBy("w").agg(F.count(F.lit(1)).alias("accepted"))
    j = rec.join(acc, "w", "left")
    return j.select(ntz_from_micros("w").alias("window_start"), "received",
                    F.coalesce("accepted", F.lit(0)).cast("long").alias("accepted"),
                    (F.col("received") - F.coalesce("accepted", F.lit(0))).cast("long").alias("suppressed"))


def alert_increase(raw: DataFrame, trades: DataFrame, window_s: int = 3_600) -> DataFrame:
    """Generated alerts by type and original severity in the hour up to
    the newest trade."""
    ref = trades.agg(F.max("u")).scalar()  # scalar subquery
    f = raw.filter((F.col("u") > ref - F.lit(window_s * 1_000_000)) & (F.col("u") <= ref))
    return f.groupBy("alert_type", "severity").agg(F.count(F.lit(1)).alias("increase"))


def closed_windows(trades: DataFrame, windows: tuple[int, ...] = WINDOWS_S) -> DataFrame:
    """One row: candles closed so far (``n``), the newest of each symbol and size being open."""
    minutes = trades.select("symbol", bucket_start_micros("u", math.gcd(*windows)).alias("m")).distinct()
    each = F.explode(F.array(*[F.struct(F.lit(s).alias("size"), bucket_start_micros("m", s).alias("w")) for s in windows]))
    seen = minutes.select("symbol", each.alias("x")).select("symbol", "x.*").distinct()
    per = seen.groupBy("symbol", "size").agg((F.count(F.lit(1)) - 1).alias("n"))
    return per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


def label_counters(trades: DataFrame, raw: DataFrame, final: DataFrame, deliveries: DataFrame) -> DataFrame:
    """The pipeline's counters, one (counter, label, value) row each.
    Trades and alerts are counted once by all their labels; the coarser
    counters sum those counts."""
    def total(df, name, label):
        return df.groupBy(label.alias("label")).agg(F.sum("n").alias("value")).select(
            F.lit(name).alias("counter"), "label", "value")

    def per(df, *labels):
        return df.groupBy(*labels).agg(F.count(F.lit(1)).alias("n"))

    sold, made = per(trades, "symbol", "side"), per(raw, "alert_type", "severity")
    sup = raw.join(final.select("alert_id"), "alert_id", "left_anti")
    parts = [
        total(sold, "trades_by_symbol", F.col("symbol")),
        total(sold, "trades_by_symbol_side", F.concat_ws(":", "symbol", "side")),
        total(made, "alerts_generated", F.concat_ws(":", "alert_type", "severity")),
        total(made, "alerts_received", F.col("alert_type")),
        total(per(sup, "alert_type"), "alerts_suppressed", F.col("alert_type")),
        total(per(deliveries, "channel"), "alerts_delivered", F.col("channel")),
        total(sold, "rows_written", F.lit("trades")),
        total(closed_windows(trades), "rows_written", F.lit("trade_aggregates")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def dedup_rate(raw: DataFrame, final: DataFrame) -> DataFrame:
    """Received vs suppressed per alert type."""
    r = raw.groupBy("alert_type").agg(F.count(F.lit(1)).alias("received"))
    k = final.groupBy("alert_type").agg(F.count(F.lit(1)).alias("kept"))
    j = r.join(k, "alert_type", "left").withColumn("kept", F.coalesce("kept", F.lit(0)).cast("long"))
    sup = F.col("received") - F.col("kept")
    return j.select("alert_type", "received", "kept", sup.alias("suppressed"),
                    (sup / F.col("received")).alias("suppressed_ratio"))


def gauges(trades: DataFrame, final: DataFrame, windows: tuple[int, ...] = WINDOWS_S) -> DataFrame:
    """Active symbols, open candle windows (each symbol holds one
    open window per size), breakers not CLOSED (symbols with an accepted trip;
    nothing resets them), total trades."""
    t = trades.agg(F.countDistinct("symbol").alias("active_symbols"), F.count(F.lit(1)).alias("trades_total"))
    breakers = final.filter(F.col("alert_type") == "CIRCUIT_BREAKER").agg(F.countDistinct("symbol")).scalar()
    return t.select("active_symbols", (F.col("active_symbols") * len(windows)).alias("open_windows"),
                    breakers.alias("open_breakers"), "trades_total")


def _bucket_counts(trades: DataFrame) -> DataFrame:
    lat = F.col("latency_us") / F.lit(1e6)
    aggs = [F.sum(F.when(lat <= F.lit(le), 1).otherwise(0)).cast("long").alias(f"b{i}")
            for i, le in enumerate(LATENCY_BUCKETS_S)]
    return trades.agg(*aggs, F.count(F.lit(1)).alias("binf"))


def latency_histogram(trades: DataFrame) -> DataFrame:
    """Cumulative bucket counts (``le`` in seconds, +Inf last)."""
    c = _bucket_counts(trades)
    les = LATENCY_BUCKETS_S + [float("inf")]
    names = [f"b{i}" for i in range(len(LATENCY_BUCKETS_S))] + ["binf"]
    arr = F.array(*[F.struct(F.lit(le).alias("le"), F.col(n).alias("cumulative_count")) for le, n in zip(les, names)])
    return c.select(F.explode(arr).alias("b")).select("b.le", "b.cumulative_count")


def latency_quantiles(trades: DataFrame, quantiles=QUANTILES) -> DataFrame:
    """p50/p95/p99 by linear interpolation inside the histogram bucket
    that holds the rank (the usual histogram-quantile rule; above the last
    finite bound the answer is that bound)."""
    c = _bucket_counts(trades)
    les = [0.0] + LATENCY_BUCKETS_S
    cums = [F.lit(0).cast("long")] + [F.col(f"b{i}") for i in range(len(LATENCY_BUCKETS_S))]
    rows = []
    for q in quantiles:
        rank = F.col("binf") * F.lit(q)
        expr = F.lit(LATENCY_BUCKETS_S[-1])  # rank falls in the +Inf bucket
        for i in range(len(LATENCY_BUCKETS_S), 0, -1):
            lo, hi, c_lo, c_hi = les[i - 1], les[i], cums[i - 1], cums[i]
            interp = F.lit(lo) + F.lit(hi - lo) * (rank - c_lo) / (c_hi - c_lo)
            expr = F.when(c_hi >= rank, interp).otherwise(expr)
        rows.append(F.struct(F.lit(q).alias("quantile"), expr.alias("latency_s")))
    return c.select(F.explode(F.array(*rows)).alias("r")).select("r.quantile", "r.latency_s")
