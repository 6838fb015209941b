"""Ordered per-key operators that stay balanced when one key is hot.

A plain ``Window.partitionBy(symbol)`` puts every row of a symbol into one
task. These helpers split the key's timeline into fixed-width time buckets,
do the row-level work inside ``(key, bucket)`` partitions (bounded by the
data rate, not the data size) and carry state between buckets through a
small per-bucket table (one row per non-empty bucket).

All order is ``(u, seq)``: ``u`` epoch microseconds, ``seq`` a unique
tie-breaker.

Inputs are read twice (row work + bucket summary); callers materialise an
expensive input once (``session.materialize``) before handing it over.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.functions.timecols import idiv

# Bucket width bounds a task: rows of one key inside one bucket. Trades are
# dense (a hot symbol may carry a third of all rows), so trade-level ranking
# uses one-minute buckets; alerts are sparse, so alert-level as-of lookups use
# ten-minute buckets. Both are parameters of every helper.
TRADE_BUCKET_US = 60 * 1_000_000
DEFAULT_BUCKET_US = 600 * 1_000_000


def _keys(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def prefix_max_before(
    df: DataFrame,
    keys: str | Sequence[str],
    value: Column,
    out: str,
    u: str = "u",
    seq: str | Sequence[str] = "seq",
    bucket_us: int = DEFAULT_BUCKET_US,
) -> DataFrame:
    """Add ``out`` = max(value) over the rows of the same key strictly before
    this row in (u, *seq) order; NULL when there is none.

    This is an as-of lookup for monotone state ("last trip time", "previous
    alert time", "current session start"): in-bucket part by a window on
    (key, bucket), earlier buckets by a cumulative max over the bucket table.
    """
    ks = _keys(keys)
    tmp_b, tmp_v, tmp_in, tmp_carry = "__b", "__v", "__in", "__carry"
    base = df.select("*", idiv(u, bucket_us).alias(tmp_b), value.alias(tmp_v))
    w_in = (Window.partitionBy(*ks, tmp_b).orderBy(u, *_keys(seq))
            .rowsBetween(Window.unboundedPreceding, -1))
    d = base.select("*", F.max(tmp_v).over(w_in).alias(tmp_in))
    # the bucket summary reads the input (column-pruned), not the windowed
    # rows: the two branches do not share an exchange, so deriving it from
    # ``d`` would recompute the window's whole upstream a second time
    per_bucket = base.groupBy(*ks, tmp_b).agg(F.max(tmp_v).alias("__bmax"))
    w_b = Window.partitionBy(*ks).orderBy(tmp_b).rowsBetween(Window.unboundedPreceding, -1)
    carry = per_bucket.select(*ks, tmp_b, F.max("__bmax").over(w_b).alias(tmp_carry))
    d = d.join(carry, on=[*ks, tmp_b], how="left")
    keep = [c for c in df.columns if c != out]
    return d.select(*keep, F.greatest(F.col(tmp_in), F.col(tmp_carry)).alias(out))


def ordinal_rank(
    df: DataFrame,
    keys: str | Sequence[str],
    out: str = "rk",
    u: str = "u",
    seq: str = "seq",
    bucket_us: int = DEFAULT_BUCKET_US,
) -> DataFrame:
    """Add ``out`` = 1-based position of the row inside its key in (u, seq)
    order, without sorting a whole key in one task: rank inside
    (key, bucket) plus the running row count of the key's earlier buckets.
    """
    ks = _keys(keys)
    base = df.select("*", idiv(u, bucket_us).alias("__b"))
    d = base.select("*", F.row_number().over(Window.partitionBy(*ks, "__b").orderBy(u, seq)).alias("__local"))
    counts = base.groupBy(*ks, "__b").agg(F.count(F.lit(1)).alias("__n"))  # from the input: see prefix_max_before
    w_b = Window.partitionBy(*ks).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*ks, "__b", F.coalesce(F.sum("__n").over(w_b), F.lit(0)).alias("__off"))
    d = d.join(offsets, on=[*ks, "__b"], how="left")
    return d.select(*[c for c in df.columns if c != out], (F.col("__off") + F.col("__local")).cast("long").alias(out))


def rolling_previous(
    df: DataFrame,
    keys: str | Sequence[str],
    sums: dict[str, Column],
    n: int,
    rk: str = "rk",
    chunk_rows: int = 200_000,
    count_name: str = "n_prior",
) -> DataFrame:
    """Sums over the previous ``n`` rows of the same key (current row
    excluded) and their count, given a dense 1-based rank ``rk`` per key.

    Rows are cut into chunks of ``chunk_rows`` ranks; the last ``n`` rows of
    each chunk are copied into the next one, so every frame is complete
    inside one (key, chunk) partition and no task holds more than
    ``chunk_rows + n`` rows. Each sum is a difference of partition-local
    running sums, ``S(r-1) - S(r-n-1)`` (exact for decimals), so the cost is
    O(rows), not O(rows * n) as with a sliding frame.
    """
    if chunk_rows < n:
        raise ValueError("chunk_rows must be at least n")
    ks = _keys(keys)
    own = F.expr(f"(`{rk}` - 1) div {int(chunk_rows)}")
    pos = (F.col(rk) - 1) % F.lit(chunk_rows)
    vals = [value.alias(f"__v{i}") for i, value in enumerate(sums.values())]  # values must be non-null
    d = df.select("*", own.alias("__own"), *vals)
    d = d.select("*", F.explode(F.when(pos >= F.lit(chunk_rows - n), F.array(F.col("__own"), F.col("__own") + 1))
                                .otherwise(F.array(F.col("__own")))).alias("__part"))
    order = Window.partitionBy(*ks, "__part").orderBy(rk)
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = d.select("*", *[F.sum(f"__v{i}").over(running).alias(f"__cs{i}") for i in range(len(sums))])
    tmp = [f"__v{i}" for i in range(len(sums))] + [f"__cs{i}" for i in range(len(sums))]
    cols = []
    for i, name in enumerate(sums):
        back = F.coalesce(F.lag(f"__cs{i}", n + 1).over(order), F.lit(0))
        cols.append(((F.col(f"__cs{i}") - F.col(f"__v{i}")) - back).alias(name))
    cols.append(F.least(F.col(rk) - 1, F.lit(n)).cast("long").alias(count_name))
    d = d.select("*", *cols)
    return d.filter(F.col("__part") == F.col("__own")).drop("__own", "__part", *tmp)
