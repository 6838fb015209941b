"""Per-symbol views over trades.

Newest-N per symbol is ``row_number() <= n``: Spark plans a partial
``WindowGroupLimit`` before the shuffle, so each map task forwards at most n
rows per symbol and a hot symbol does not flood one reducer. Latest row per
symbol is ``max_by`` (partial aggregation, no sort).
"""
from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick.functions.numeric import dec
from candlewick.functions.timecols import idiv, ntz_from_micros
from candlewick.operators.history import page

RECENT_N = 100  # ring buffer length of the recent-trades view
SERIES_N = 1000  # length of the per-symbol price series


def parse_symbols(symbols: str | Iterable[str] | None) -> list[str] | None:
    """comma list -> stripped upper-case symbols; None/empty -> all."""
    if symbols is None:
        return None
    items = symbols.split(",") if isinstance(symbols, str) else list(symbols)
    out = [s.strip().upper() for s in items if s and s.strip()]
    return out or None


def check_bounds(name: str, value: int, lo: int, hi: int | None = None) -> int:
    """argument bounds as the API enforces them."""
    if value < lo or (hi is not None and value > hi):
        raise ValueError(f"{name}={value} outside [{lo}, {hi if hi is not None else 'inf'}]")
    return value


def _with_symbols(trades: DataFrame, symbols) -> DataFrame:
    syms = parse_symbols(symbols)
    return trades if syms is None else trades.filter(F.col("symbol").isin(syms))


def latest_price(trades: DataFrame, symbols=None) -> DataFrame:
    """W5 + F2: price, ts and side of each symbol's newest trade."""
    t = _with_symbols(trades, symbols)
    last = t.groupBy("symbol").agg(F.max_by(F.struct("price", "ts", "side", "u"), F.struct("u", "seq")).alias("l"))
    return last.select("symbol", F.col("l.price").alias("price"), F.col("l.ts").alias("ts"),
                       F.col("l.side").alias("side"))


def recent_trades(trades: DataFrame, limit: int = 50, symbols=None) -> DataFrame:
    """Newest ``limit`` (1-100) trades per symbol, rn 1 = newest."""
    check_bounds("limit", limit, 1, RECENT_N)
    t = _with_symbols(trades, symbols)
    w = Window.partitionBy("symbol").orderBy(F.col("u").desc(), F.col("seq").desc())
    return (t.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= limit)
            .select("symbol", "price", "quantity", "side", "ts", F.col("rn").cast("int").alias("rn")))


def price_history(trades: DataFrame, limit: int = 100, symbols=None) -> DataFrame:
    """The newest ``limit`` (10-500) members of each symbol's price series.

    The series is a set of (price, ts) scored by arrival: a repeated member
    keeps its newest score. ``rn`` counts from the newest (1); the API returns
    them oldest first (``ORDER BY rn DESC``).
    """
    check_bounds("limit", limit, 10, 500)
    t = _with_symbols(trades, symbols)
    # members of one instant share ``u``: the newest ``limit`` instants hold the newest ``limit`` members
    newest = F.dense_rank().over(Window.partitionBy("symbol").orderBy(F.col("u").desc()))
    t = t.select("symbol", "price", "ts", "u", "seq", newest.alias("instant")).filter(F.col("instant") <= limit)
    members = t.groupBy("symbol", "price", "ts").agg(F.max(F.struct("u", "seq")).alias("score"))
    w = Window.partitionBy("symbol").orderBy(F.col("score").desc())
    return (members.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= min(limit, SERIES_N))
            .select("symbol", "price", "ts", (F.col("score.u") / 1000).cast("long").alias("ms"),
                    F.col("rn").cast("int").alias("rn")))


def trade_history(trades: DataFrame, symbol: str | None = None, limit: int = 100, offset: int = 0,
                  index: DataFrame | None = None) -> DataFrame:
    """Newest-first page of the trade table, optional symbol. The first
    page is a top-``limit``; a later one is found by seeking (``history``), with
    ``index`` (``history.count_index`` of the table) or one counting pass."""
    check_bounds("limit", limit, 1, 1000)
    check_bounds("offset", offset, 0)
    t = trades
    if symbol:
        own = F.col("symbol") == symbol.strip().upper()
        t, index = t.filter(own), None if index is None else index.filter(own)
    return page(t, limit, offset, index).select(
        "trade_id", "symbol", "price", "quantity",
        (dec("price") * dec("quantity")).cast("double").alias("trade_value"),
        "side", "exchange", "ts",
    )


def ref_time(trades: DataFrame, ref_u: int | None = None) -> F.Column:
    """Reference time "now" (D1): the newest trade unless given, as a scalar
    subquery (one partial/final aggregate, value inlined; no join)."""
    return F.lit(ref_u).cast("long") if ref_u is not None else trades.agg(F.max("u")).scalar()


def latest_run(trades: DataFrame, ttl_s: int, carried: DataFrame | None = None) -> DataFrame:
    """Each symbol's newest run of trades without a silence of ``ttl_s``: symbol, n, first_u, last_u.

    Such a silence shows between buckets of width ``ttl_s``, so one row per symbol and bucket carries all that is needed.
    ``carried`` holds runs of earlier trades in the same form; a run goes on where the silence after it is short enough."""
    ttl = ttl_s * 1_000_000
    per_b = trades.groupBy("symbol", idiv("u", ttl).alias("b")).agg(
        F.count(F.lit(1)).alias("n"), F.min("u").alias("first_u"), F.max("u").alias("last_u"))
    per_b = per_b.select("symbol", "n", "first_u", "last_u", F.col("first_u").alias("at"))
    if carried is not None:  # before the symbol's new trades
        per_b = per_b.unionByName(carried.select("symbol", "n", "first_u", "last_u", F.lit(-1).cast("long").alias("at")))
    w = Window.partitionBy("symbol").orderBy("at")
    fresh = F.col("first_u") - F.max("last_u").over(w.rowsBetween(Window.unboundedPreceding, -1)) >= ttl
    runs = per_b.select("*", F.when(fresh, 1).otherwise(0).alias("fresh"))
    runs = runs.select("*", F.sum("fresh").over(w).alias("run"))
    runs = runs.groupBy("symbol", "run").agg(F.sum("n").alias("n"), F.min("first_u").alias("first_u"), F.max("last_u").alias("last_u"))
    last = runs.groupBy("symbol").agg(F.max_by(F.struct("n", "first_u", "last_u"), "run").alias("l"))
    return last.select("symbol", "l.*")


def trade_counts(trades: DataFrame, ttl_s: int = 86_400, ref_u: int | None = None) -> DataFrame:
    """Each symbol's trade counter at ``ref``. It counts every trade and
    starts anew after ``ttl_s`` of silence; a symbol that has been silent for
    so long at ``ref`` has none."""
    ref = ref_time(trades, ref_u)
    t = trades if ref_u is None else trades.filter(F.col("u") <= ref)
    alive = latest_run(t, ttl_s).filter(ref - F.col("last_u") < ttl_s * 1_000_000)
    return alive.select("symbol", F.col("n").alias("trade_count"))


def active_views(trades: DataFrame, view_ttl_s: int = 3_600, counter_ttl_s: int = 86_400,
                 ref_u: int | None = None) -> DataFrame:
    """Which per-symbol views are still alive at ``ref`` (expiry after
    inactivity: price/trades/series views ``view_ttl_s``, counter ``counter_ttl_s``)."""
    ref = ref_time(trades, ref_u)
    last = trades.groupBy("symbol").agg(F.max("u").alias("last_u"))
    age = ref - F.col("last_u")
    return last.select(
        "symbol", ntz_from_micros("last_u").alias("last_trade_ts"),
        (age < F.lit(view_ttl_s * 1_000_000)).alias("views_live"),
        (age < F.lit(counter_ttl_s * 1_000_000)).alias("counter_live"),
    )


def retained_trades(trades: DataFrame, retention_s: int = 30 * 86_400, ref_u: int | None = None) -> DataFrame:
    """Raw trades inside the retention horizon (older ones are dropped).
    On a date-partitioned table the same predicate prunes whole partitions."""
    ref = ref_time(trades, ref_u)
    return trades.filter(F.col("u") >= ref - F.lit(retention_s * 1_000_000)).select(
        "trade_id", "symbol", "price", "quantity", "side", "exchange", "trader_id", "ts", "seq")
