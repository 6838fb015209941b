"""What the streaming jobs carry from one micro-batch to the next, as tables.

A micro-batch is worked on by the batch operators, which deal a hot symbol over many tasks; the little they need of the past
comes from a versioned table of one short row set for each symbol: the tail of its trades for the rolling baseline, the last
kept alert of each type for cooldowns and breakers, and the state of its views. Tables are written under the batch's id, so
a replayed batch finds the state before it. Joins with these tables are plain: they are small, so that AQE broadcasts them
after measuring, and splits a hot symbol where it cannot.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick.operators import alerts, detect
from candlewick.operators.views import RECENT_N, SERIES_N, latest_run
from candlewick.session import materialize

# --- detector: the tail of each symbol's trades (X5) --------------------------

TAIL_COLUMNS = ["symbol", "pos", "price", "quantity"]


def with_tail(trades: DataFrame, tail: DataFrame | None) -> DataFrame:
    """The batch's trades behind the carried ones, which get the first microseconds of the epoch as their times: they come
    before every trade of the batch, as they were processed before it."""
    new = trades.select("trade_id", "symbol", "price", "quantity", "side", "ts", "u", "seq")
    if tail is None:
        return new
    return new.unionByName(tail.select("symbol", "price", "quantity", F.col("pos").cast("long").alias("u"), F.col("pos").cast("long").alias("seq")),
                           True)


def batch_alerts(with_past: DataFrame, **kw) -> DataFrame:
    """Raw alerts of the batch's own trades; ``kw`` as in ``detect.rolling_stats``."""
    stats = detect.rolling_stats(with_past, **kw).where(F.col("u") > detect.LOOKBACK)
    return detect.alerts_from_stats(stats)


def new_tail(with_past: DataFrame, n: int = detect.LOOKBACK) -> DataFrame:
    """The newest ``n`` trades of each symbol that the batch has trades of; ``pos`` rises with time, up to ``n``."""
    back = Window.partitionBy("symbol").orderBy(F.desc("u"), F.desc("seq"))  # group limit before the shuffle
    newest = with_past.withColumn("rn", F.row_number().over(back)).where(F.col("rn") <= n)
    touched = F.max(F.when(F.col("rn") == 1, F.col("u"))).over(Window.partitionBy("symbol"))
    return newest.withColumn("t", touched).where(F.col("t") > n).select(
        "symbol", (F.lit(n + 1) - F.col("rn")).cast("long").alias("pos"), "price", "quantity")


# --- alert engine: the last kept alert of each type and symbol (X6, X7) --------

def due(raw: DataFrame, carried: DataFrame | None) -> DataFrame:
    """The alerts that a kept alert of an earlier batch does not suppress. From the first of them on, the batch keeps what it
    would keep without a past, since a cooldown starts at the last kept alert only."""
    if carried is None:
        return raw
    last = carried.select("alert_type", "symbol", F.col("u").alias("__last"))
    free = F.col("__last").isNull() | (F.col("u") - F.col("__last") >= alerts.cooldown_us(F.col("alert_type")))
    return raw.join(last, alerts.KEYS, "left").where(free).drop("__last")


def batch_final(raw: DataFrame, carried: DataFrame | None) -> DataFrame:
    """Accepted, escalated alerts of a batch; the last kept CIRCUIT_BREAKER is a symbol's last trip."""
    kept = materialize(alerts.dedup_cooldown(due(raw, carried)))
    trips = None
    if carried is not None:
        trips = carried.where("alert_type = 'CIRCUIT_BREAKER'").select("symbol", F.col("u").alias("carried_trip_u"))
    return alerts.escalate(alerts.breaker_states(kept, carried_trips=trips)).drop("trip_u")


def new_kept(final: DataFrame) -> DataFrame:
    return final.groupBy("alert_type", "symbol").agg(F.max("u").alias("u"))


def alert_totals(final: DataFrame, before: DataFrame | None) -> DataFrame:
    """gid, name, alert_count: the totals that a batch's alerts change, with them added. ``gid`` as in ``alerts.alert_counts``;
    ``name`` is the symbol or the severity."""
    new = alerts.alert_counts(final).select("gid", F.coalesce("symbol", "severity", F.lit("")).alias("name"), "alert_count")
    if before is None:
        return new
    old = before.withColumnRenamed("alert_count", "before")
    both = new.join(old, ["gid", "name"], "left")
    return both.select("gid", "name", (F.col("alert_count") + F.coalesce("before", F.lit(0))).alias("alert_count"))


# --- views (K7) with expiry (X8) ------------------------------------------------

#: Rows of each view that a symbol may have.
VIEW_ROWS = {"price": 1, "trades": RECENT_N, "series": SERIES_N}
VIEW_TTL_S, COUNTER_TTL_S = 3_600, 86_400


def runs_and_gone(trades: DataFrame, carried: DataFrame | None, ttl_s: int) -> DataFrame:
    """symbol, n, first_u, last_u, deleted: the run of each symbol of the batch or carried that changes: it has trades in
    the batch, or its silence has reached ``ttl_s`` at the newest trade so far."""
    fresh = latest_run(trades, ttl_s, carried)
    clock = fresh.agg(F.max("last_u")).scalar()
    if carried is None:
        touched = fresh.withColumn("touched", F.lit(True))
    else:
        own = trades.select("symbol").distinct().withColumn("touched", F.lit(True))
        touched = fresh.join(own, ["symbol"], "left").withColumn("touched", F.coalesce("touched", F.lit(False)))
    out = touched.withColumn("deleted", clock - F.col("last_u") >= ttl_s * 1_000_000)
    return out.where("touched or deleted").drop("touched")


def _members(view: str, trades: DataFrame) -> DataFrame:
    """Rows of a view that trades give, newest last by (u, seq)."""
    if view == "series":  # a set of (price, ts): a repeated member keeps its newest score
        top = trades.groupBy("symbol", "price", "ts").agg(F.max(F.struct("u", "seq")).alias("s"))
        return top.select("symbol", "price", "ts", "s.u", "s.seq")
    return trades.select("symbol", "price", "quantity", "side", "ts", "u", "seq")


def _newest(rows: DataFrame, n: int) -> DataFrame:
    order = Window.partitionBy("symbol").orderBy(F.desc("u"), F.desc("seq"))
    return rows.withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= n).drop("rn")


def new_view(view: str, trades: DataFrame, carried: DataFrame | None, runs: DataFrame) -> DataFrame:
    """The new rows of a view for the symbols of ``runs`` (of ``runs_and_gone``): the newest of the symbol's present run,
    carried ones and new; one row that deletes the symbol where its silence has reached the limit."""
    n = VIEW_ROWS[view]
    rows = _newest(trades.select("symbol", "price", "quantity", "side", "ts", "u", "seq"), n) if view != "series" else _series_rows(trades, n)
    if carried is not None:
        rows = rows.unionByName(carried.select(*rows.columns))
    rows = _newest(_members(view, rows) if view == "series" else rows, n)
    alive = runs.where("not deleted").select("symbol", F.col("first_u").alias("__from"))
    rows = rows.join(alive, ["symbol"], "left").where(F.col("u") >= F.col("__from")).drop("__from")
    gone = runs.where("deleted").select("symbol", F.lit(True).alias("deleted"))
    return rows.withColumn("deleted", F.lit(False)).unionByName(gone, True)


def _series_rows(trades: DataFrame, n: int) -> DataFrame:
    """The newest ``n`` members of the batch: the newest ``n`` instants hold them, as all rows of one member share theirs."""
    instant = F.dense_rank().over(Window.partitionBy("symbol").orderBy(F.desc("u")))
    return _members("series", trades.withColumn("__i", instant).where(F.col("__i") <= n))


def last_candles(closed: DataFrame, carried: DataFrame | None) -> DataFrame:
    """The newest closed candle of each symbol and size among a batch's and the carried ones."""
    cols = [c for c in closed.columns if c not in ("symbol", "window_seconds")]
    both = closed if carried is None else closed.unionByName(carried.select(*closed.columns))
    g = both.groupBy("symbol", "window_seconds").agg(F.max_by(F.struct(*cols), "window_start").alias("c"))
    return g.select("symbol", "window_seconds", "c.*")


# --- counters (A9, A13) -----------------------------------------------------------

def counted(df: DataFrame, counter: str, *labels: str) -> DataFrame:
    """counter, label, value of one batch."""
    g = df.groupBy(F.concat_ws(":", *labels).alias("label")).agg(F.count(F.lit(1)).alias("value"))
    return g.select(F.lit(counter).alias("counter"), "label", "value")
