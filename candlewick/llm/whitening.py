"""Embedding whitening by bit-sliced scatter.

Every entry c becomes the integer x = floor(SCALE * c) + OFFSET. Tasks take blocks of rows, shift each dimension by its
least value in the block, and pack the bits of equal weight of all rows into words, one bit plane for each dimension and
weight. The cross-product of two dimensions is then a sum over pairs of planes: 2 to the power of both weights, times the
bits set in both planes. Blocks give exact integers, which Spark adds up as decimals. What reaches the driver is one row for
each pair of dimensions, whatever the number of vectors; there the cross-products are centred as integers (n * sum(x y) -
sum(x) * sum(y)) and divided once, for the eigenvectors in double precision.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage, table, workers_ready

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
#: Rows whose planes are held at once.
ROWS = 8192


def finite_vectors(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, x (array<long>): the vectors without null or non-finite entries, as integers."""
    c = F.transform(F.col(vector_col), lambda v: v.cast("double"))
    finite = F.forall(c, lambda v: F.coalesce(F.abs(v) < float("inf"), F.lit(False)))  # NaN sorts above infinity
    x = F.transform(c, lambda v: F.floor(v * SCALE).cast("long") + OFFSET)
    return embeddings.where(F.col(vector_col).isNotNull() & finite).select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x"))


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """Rows of a list column as a matrix; entries that a shorter vector lacks are those of c = 0."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    size = np.diff(column.offsets.to_numpy())
    if len(size) and (size == width).all():
        return flat.reshape(-1, width)
    out = np.full((len(size), width), OFFSET, np.int64)
    out[np.arange(width) < size[:, None]] = flat
    return out


def cross_products(y: np.ndarray) -> np.ndarray:
    """Exact y.T @ y of non-negative integers (rows x dimensions) by bit planes."""
    rows, width = y.shape
    bits = max(1, int(y.max()).bit_length()) if y.size else 1
    planes = np.zeros((width * bits, -(-rows // 64) * 8), np.uint8)
    for b in range(bits):
        packed = np.packbits(((y >> b) & 1).astype(np.uint8), axis=0)
        planes[b::bits, : len(packed)] = packed.T
    words = planes.view(np.uint64)
    both = np.empty((len(words), len(words)), np.int64)
    for k, plane in enumerate(words):
        both[k, k:] = np.bitwise_count(plane & words[k:]).sum(axis=1, dtype=np.int64)
        both[k:, k] = both[k, k:]
    both = both.reshape(width, bits, width, bits)
    if 2 * bits + rows.bit_length() < 62:
        weight = np.int64(1) << np.arange(bits, dtype=np.int64)
    else:
        both, weight = both.astype(object), np.array([1 << b for b in range(bits)], object)
    return np.tensordot(np.tensordot(both, weight, (3, 0)), weight, (1, 0))


class Scatter:
    """Exact number, sums and cross-products of the vectors seen, as differences from ``OFFSET``."""

    def __init__(self, width: int):
        self.n = 0
        self.sums = np.zeros(width, object)
        self.cross = np.zeros((width, width), object)

    def add(self, x: np.ndarray) -> None:
        low = x.min(axis=0)
        y = x - low
        t = (low - OFFSET).astype(object)
        s = y.sum(axis=0).astype(object)
        ts = np.outer(t, s)
        self.n += len(x)
        self.sums += s + t * len(x)
        self.cross += cross_products(y).astype(object) + ts + ts.T + np.outer(t, t) * len(x)


def _scatter(width: int):
    def run(batches):
        total = Scatter(width)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                total.add(_matrix(batch.column("x").slice(at, ROWS), width))
        if total.n:
            i, j = np.triu_indices(width)
            values = [str(total.n)] + [str(v) for v in total.sums] + [str(v) for v in total.cross[i, j]]
            ids = [np.append([-1] * (width + 1), i), np.concatenate([[-1], np.arange(width), j])]
            yield pa.RecordBatch.from_arrays([pa.array(ids[0], pa.int32()), pa.array(ids[1], pa.int32()), pa.array(values)],
                                             ["i", "j", "v"])

    return run


@dataclass
class Whitening:
    """n vectors, their sums (of x - OFFSET), eigenvalues by falling size, unit eigenvectors as columns, trace of the covariance."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def width(self) -> int:
        return len(self.sums)


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """vectors: x (array<long>) -> the first ``components`` eigenvectors of their covariance; None without vectors.

    Eigenvalues that are zero but for rounding have no whitened component and are left out. Shorter vectors count as if
    filled up with c = 0. Every row counts, repeated ones too. The driver holds a matrix of the vectors' width.
    """
    workers_ready(vectors.sparkSession)
    width = vectors.agg(F.max(F.size("x"))).head()[0]
    if not width:
        return None
    parts = vectors.select("x").mapInArrow(_scatter(width), "i int, j int, v string")
    rows = parts.groupBy("i", "j").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect()
    n, sums, cross = 0, [0] * width, np.zeros((width, width), object)
    for i, j, v in rows:
        v = int(v)
        if i >= 0:
            cross[i, j] = cross[j, i] = v
        elif j >= 0:
            sums[j] = v
    n = next(int(v) for i, j, v in rows if i == -1 and j == -1)
    return from_integers(n, sums, cross, components)


def from_integers(n: int, sums: list[int], cross: np.ndarray, components: int) -> Whitening:
    s = np.array(sums, object)
    centred = cross * n - np.outer(s, s)
    v = np.array([[c / (n * n) for c in row] for row in centred], float)  # one correctly rounded division for each entry
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1]
    trace = sum(int(centred[k, k]) for k in range(len(sums))) / (n * n)
    use = min(components, int((values > len(sums) * np.finfo(float).eps * max(trace, 0.0)).sum()))
    return Whitening(n, sums, values[:use].copy(), vectors[:, :use].copy(), trace)


def _centred(x: np.ndarray, w: Whitening) -> np.ndarray:
    """n * x - S, exact; Python integers where 64 bits may not do."""
    z, s = x - OFFSET, w.sums
    big = max(int(abs(z).max(initial=0)) * w.n, max(map(abs, s)))
    if big < 1 << 61:
        return z * np.int64(w.n) - np.array(s, np.int64)
    return z.astype(object) * w.n - np.array(s, object)


def _deviation(d: np.ndarray) -> list[int | None]:
    """Exact sum of squares of each row; None where it does not fit into a long."""
    if d.dtype != object and d.size and float(abs(d).max()) ** 2 * d.shape[1] < 2.0**62:
        return (d * d).sum(axis=1).tolist()
    out = [sum(int(v) * int(v) for v in row) for row in d]
    return [v if v < 1 << 63 else None for v in out]


def _project(w: Whitening):
    scale = w.vectors / np.sqrt(w.values)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                d = _centred(_matrix(part.column("x"), w.width), w)
                z = np.ascontiguousarray((d / w.n).astype(float) @ scale)
                offsets = np.arange(0, z.size + 1, z.shape[1], dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id"), pa.array(_deviation(d), pa.int64()), pa.ListArray.from_arrays(offsets, z.ravel())],
                    ["vec_id", "deviation", "whitened"])

    return run


def _second_moments(k: int):
    def run(batches):
        n, s, m = 0, np.zeros(k), np.zeros((k, k))
        for batch in batches:
            z = batch.column("whitened").flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
            n, s, m = n + len(z), s + z.sum(axis=0), m + z.T @ z
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([s.tolist()]), pa.array([m.ravel().tolist()])], ["n", "s", "m"])

    return run


def identity_error(whitened: DataFrame, k: int) -> float:
    """Largest absolute entry of the covariance (divisor n) of ``whitened`` (arrays of k) minus the identity."""
    parts = whitened.select("whitened").mapInArrow(_second_moments(k), "n long, s array<double>, m array<double>")
    flat = parts.select("n", F.posexplode(F.concat("s", "m")).alias("at", "v"))
    rows = flat.groupBy("at").agg(F.sum("v").alias("v"), F.sum("n").alias("n")).orderBy("at").collect()  # k + k * k rows
    n, v = rows[0].n, np.array([r.v for r in rows])
    mean = v[:k] / n
    return float(np.abs(v[k:].reshape(k, k) / n - np.outer(mean, mean) - np.eye(k)).max())


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vectors: vec_id, x (array<long>, not null) -> vec_id, component (from 1), n, deviation, whitened, explained,
    identity_error: a row for each vector and component.

    Ids may be null or repeat and rows may be equal: every row is a vector of its own and counts. Without vectors, or if
    all are equal, there is no component and the result is empty. ``deviation`` is null where it does not fit into a long.
    """
    spark = vectors.sparkSession
    vectors = stage(vectors.select("vec_id", "x"), "vectors")
    w = fit(vectors, components)
    if w is None or not len(w.values):
        return spark.createDataFrame([], "vec_id long, component int, n long, deviation long, whitened double, explained double, "
                                         "identity_error double")
    out = stage(vectors.mapInArrow(_project(w), "vec_id long, deviation long, whitened array<double>"), "whitened")
    error = identity_error(out, len(w.values))
    explained = F.array(*[F.lit(float(e / w.trace)) for e in w.values])
    out = out.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return out.select("vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(w.n).cast("long").alias("n"), "deviation",
                      "whitened", F.element_at(explained, F.col("at") + 1).alias("explained"), F.lit(error).alias("identity_error"))


def op13(spark, sf_dir) -> DataFrame:
    return whiten(finite_vectors(table(spark, sf_dir, "embeddings")))
