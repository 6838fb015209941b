"""Helpers shared by the operators of this subpackage."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, ship_package

#: Rows that may be broadcast; a table that has more goes another way.
BROADCAST_ROWS = 100_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared checkpoint folder and read back."""
    return materialize(df, name)


def workers_ready(spark: SparkSession) -> None:
    """Make this package importable in the Python workers."""
    ship_package(spark)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fits(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """True if ``df`` has at most ``rows`` rows (counts no further than that)."""
    return df.limit(rows + 1).count() <= rows


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint where its row count allows one; beyond it a plain shuffle join follows."""
    return F.broadcast(df) if fits(df, rows) else df


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII text takes ``lower``, which is much faster than ``translate``."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def by_group(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int = 1) -> Iterator[pa.Table]:
    """Tables that each hold whole groups of consecutive rows with equal ``keys`` and, if there are so many, ``rows`` rows
    or more. The input must be sorted by the keys."""
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        count += batch.num_rows
        if count < rows:
            continue
        whole = pa.Table.from_batches(held).combine_chunks()
        cut = np.zeros(whole.num_rows, bool)
        for k in keys:
            v = whole.column(k).to_numpy()
            cut[1:] |= v[1:] != v[:-1]
        starts = np.flatnonzero(cut)
        if not len(starts):
            held = whole.to_batches()
            continue
        at = 0
        for s in starts:
            if s - at >= rows or s == starts[-1]:
                yield whole.slice(at, s - at)
                at = int(s)
        rest = whole.slice(at)
        held, count = rest.to_batches(), rest.num_rows
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def runs(*cols: np.ndarray) -> np.ndarray:
    """Start indexes of runs of equal values, and the end."""
    n = len(cols[0])
    cut = np.zeros(n, bool)
    if n:
        cut[0] = True
    for v in cols:
        cut[1:] |= v[1:] != v[:-1]
    return np.append(np.flatnonzero(cut), n)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (u, v: long): a row (node, component) for every node, component being the
    smallest node of its component.

    Each round maps every node to its smallest neighbour (or itself) and carries the edges over to the images, so
    that a star goes in one round and a path in a logarithmic number of them. Rounds are staged; only emptiness tests
    reach the driver.
    """
    edges = stage(edges.where("u <> v").select("u", "v").distinct(), "edges")
    label = None
    while not edges.isEmpty():
        both = edges.union(edges.select("v", "u"))
        step = stage(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "step")
        if label is None:
            label = step.select(F.col("u").alias("node"), F.col("m").alias("component"))
        else:
            s = step.select(F.col("u").alias("component"), "m")
            label = label.join(s, "component", "left").select("node", F.coalesce("m", "component").alias("component"))
            label = stage(label, "label")
        a = step.select("u", F.col("m").alias("mu"))
        b = step.select(F.col("u").alias("v"), F.col("m").alias("mv"))
        edges = edges.join(a, "u").join(b, "v").where("mu <> mv").select(
            F.greatest("mu", "mv").alias("u"), F.least("mu", "mv").alias("v")).distinct()
        edges = stage(edges, "edges")
    if label is None:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return label
