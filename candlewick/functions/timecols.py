"""Time helpers that do not depend on the session time zone.

Everything inside the engine orders and buckets by ``u`` = epoch microseconds
(long). Output timestamps are ``timestamp_ntz`` so the same wall-clock value
comes out whatever ``spark.sql.session.timeZone`` is.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def epoch_micros(ts: Column | str) -> Column:
    """Epoch microseconds of a ``timestamp_ntz`` column (read as UTC)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), c)


def ntz_from_micros(u: Column | str) -> Column:
    """``timestamp_ntz`` for epoch microseconds."""
    c = F.col(u) if isinstance(u, str) else u
    return F.timestamp_add("MICROSECOND", c, F.expr(_EPOCH_NTZ))


def idiv(name: str, n: int) -> Column:
    """Exact integer division of a non-negative long column by a constant."""
    return F.expr(f"`{name}` div {int(n)}")


def bucket_start_micros(u: str, seconds: int) -> Column:
    """Epoch-aligned tumbling-window start, ``(u div w) * w`` in microseconds."""
    w = int(seconds) * 1_000_000
    return idiv(u, w) * F.lit(w)
