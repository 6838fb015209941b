"""Alert message text.

The messages use printf-style rounding of the *exact* binary value
(``format(x, ".4f")``); the JVM's ``format_string`` rounds the shortest decimal
form half-up and disagrees on a few values per thousand. So the text is built
by a small Arrow-batched pandas UDF, evaluated only on alert rows that are
output, never on the trade stream.
"""
from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Alert text formats per alert type
ALERT_TEXT = {
    "CIRCUIT_BREAKER": "CIRCUIT BREAKER: {symbol} price moved {change:.1%} (avg={avg:.4f}, current={price:.4f})",
    "PRICE_SPIKE": "Price spike on {symbol}: {change:.1%} move (avg={avg:.4f}, current={price:.4f})",
    "VOLUME_SPIKE": "Volume spike on {symbol}: {qty:.2f} vs avg {avg_qty:.2f} ({mult:.1f}x)",
}


def format_alert(kind, symbol, change, avg, price, qty, avg_qty):
    fmt = ALERT_TEXT.get(kind)
    if fmt is None:
        return None
    mult = qty / avg_qty if kind == "VOLUME_SPIKE" else None
    return fmt.format(symbol=symbol, change=change, avg=avg, price=price, qty=qty, avg_qty=avg_qty, mult=mult)


@F.pandas_udf(T.StringType())
def _alert_message(alert_type: pd.Series, symbol: pd.Series, change_pct: pd.Series, avg_price: pd.Series,
                   price: pd.Series, quantity: pd.Series, avg_volume: pd.Series) -> pd.Series:
    return pd.Series([format_alert(*row) for row in zip(alert_type, symbol, change_pct, avg_price, price,
                                                         quantity, avg_volume)], dtype=object)


def alert_message(alert_type: Column, symbol: Column, change_pct: Column, avg_price: Column, price: Column,
                  quantity: Column, avg_volume: Column) -> Column:
    return _alert_message(alert_type, symbol, change_pct, avg_price, price, quantity, avg_volume)
