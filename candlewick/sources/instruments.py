"""Instrument dimension (watchlist groups). Ten fixed rows, broadcast-safe by
construction (its size does not grow with the data)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The instrument list in its configured order with its asset
# class and venue. ``alias`` is the fixture symbol mapped to the instrument at
# the same position (fixture symbols are SYM0..SYM9).
INSTRUMENTS = [
    ("AAPL", "Stocks", "NASDAQ"),
    ("GOOGL", "Stocks", "NASDAQ"),
    ("MSFT", "Stocks", "NASDAQ"),
    ("AMZN", "Stocks", "NASDAQ"),
    ("TSLA", "Stocks", "NASDAQ"),
    ("BTC-USD", "Crypto", "COINBASE"),
    ("ETH-USD", "Crypto", "COINBASE"),
    ("EUR-USD", "Forex", "FX"),
    ("GBP-USD", "Forex", "FX"),
    ("JPY-USD", "Forex", "FX"),
]


def instruments(spark: SparkSession) -> DataFrame:
    rows = [(f"SYM{i}", name, cls, ex) for i, (name, cls, ex) in enumerate(INSTRUMENTS)]
    return spark.createDataFrame(rows, "symbol string, instrument string, asset_class string, exchange string")


def instruments_sql() -> str:
    vals = ", ".join(f"('SYM{i}', '{n}', '{c}', '{e}')" for i, (n, c, e) in enumerate(INSTRUMENTS))
    return f"(VALUES {vals}) AS ins(symbol, instrument, asset_class, exchange)"
