"""The ``trades`` relation derived from the supplied ``events`` table.

No trade table is supplied, so trades are a deterministic projection of
``events`` (10 symbols, prices on a 0.22 grid around 100, time compressed 60x
around 2024-01-01 so cooldowns and breaker timeouts matter). Pure column
expressions: the scan stays pruned and the projection fuses into codegen.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.functions.timecols import epoch_micros, idiv, ntz_from_micros
from candlewick.sources.tables import read_table

# Fixed values of the mapping (must equal the oracle SQL)
BASE_US = 1_704_067_200_000_000  # 2024-01-01T00:00:00Z
TIME_COMPRESSION = 60
N_SYMBOLS = 10
PRICE_STEP = 0.22

TRADE_COLUMNS = [
    "trade_id", "symbol", "price", "quantity", "side", "exchange", "trader_id",
    "ts", "u", "seq", "latency_us",
]


def trades_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value", "props"])
    k = F.get_json_object("props", "$.k").cast("int")
    e = e.withColumn("__d", epoch_micros("ts") - F.lit(BASE_US))
    u = F.lit(BASE_US) + idiv("__d", TIME_COMPRESSION)
    t = e.select(
        F.col("event_id").cast("string").alias("trade_id"),
        F.concat(F.lit("SYM"), (F.col("user_id") % N_SYMBOLS).cast("string")).alias("symbol"),
        (F.lit(100.0) + (k - F.lit(50)).cast("double") * F.lit(PRICE_STEP)).alias("price"),
        F.col("value").alias("quantity"),
        F.when(F.col("event_id") % 2 == 0, F.lit("BUY")).otherwise(F.lit("SELL")).alias("side"),
        F.col("event_type").alias("exchange"),
        F.col("user_id").cast("string").alias("trader_id"),
        u.alias("u"),
        F.col("event_id").alias("seq"),
        (F.lit(50) + (F.col("event_id") * 37) % 4951).cast("int").alias("latency_us"),
    ).withColumn("ts", ntz_from_micros("u")).select(*TRADE_COLUMNS)
    return t


# SQL twin used by the DuckDB oracle (kept next to the Spark form on purpose)
TRADES_SQL = f"""
SELECT CAST(event_id AS VARCHAR) AS trade_id,
       'SYM' || CAST(user_id % {N_SYMBOLS} AS VARCHAR) AS symbol,
       100.0 + CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) - 50 AS DOUBLE) * CAST({PRICE_STEP} AS DOUBLE) AS price,
       value AS quantity,
       CASE WHEN event_id % 2 = 0 THEN 'BUY' ELSE 'SELL' END AS side,
       event_type AS exchange,
       CAST(user_id AS VARCHAR) AS trader_id,
       make_timestamp({BASE_US} + (epoch_us(ts) - {BASE_US}) // {TIME_COMPRESSION}) AS ts,
       {BASE_US} + (epoch_us(ts) - {BASE_US}) // {TIME_COMPRESSION} AS u,
       event_id AS seq,
       CAST(50 + (event_id * 37) % 4951 AS INTEGER) AS latency_us
FROM events
"""
