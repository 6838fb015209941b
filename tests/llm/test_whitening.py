import random
from fractions import Fraction

import numpy as np
import pytest
from paths import SF

from candlewick.llm import whitening
from pyspark.sql import functions as F


def _brute(rows, k):
    """rows: (vec_id, list of c) -> n, deviations, covariance as fractions"""
    x = [[int(np.floor(float(c) * 64)) + 1_000_000 for c in v] for _, v in rows]
    n, d = len(x), len(x[0])
    s = [sum(r[j] for r in x) for j in range(d)]
    dev = [sum((n * r[j] - s[j]) ** 2 for j in range(d)) for r in x]
    cov = [[Fraction(sum((n * r[i] - s[i]) * (n * r[j] - s[j]) for r in x), n**3) for j in range(d)] for i in range(d)]
    return n, x, s, dev, cov


def _check(got, rows, k=32):
    n, x, s, dev, cov = _brute(rows, k)
    v = np.array([[float(c) for c in r] for r in cov])
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    by = {}
    for r in got:
        by.setdefault(r.vec_id, {})[r.component] = r
    white = np.array([[by[i][c + 1].whitened for c in range(len(e))] for i, _ in rows])
    want = (np.array(x) - np.array(s) / n) @ u / np.sqrt(e)
    sign = np.sign((white * want).sum(axis=0))
    assert np.abs(white * sign - want).max() < 1e-6
    assert [by[i][1].deviation for i, _ in rows] == dev
    for c in range(len(e)):
        assert abs(by[rows[0][0]][c + 1].explained / (e[c] / np.trace(v)) - 1) < 1e-6
    cov_w = np.cov(white.T, bias=True)
    assert abs(np.abs(cov_w - np.eye(len(e))).max() - got[0].identity_error) < 1e-9 and got[0].identity_error < 1e-4
    assert {r.n for r in got} == {n}


@pytest.mark.parametrize("rows,width,top", [(1, 3, 10), (63, 2, 1 << 20), (64, 5, 1), (200, 7, 1000), (70, 2, 1 << 40)])
def test_cross_products(rows, width, top):
    rng = random.Random(rows)
    y = np.array([[rng.randint(0, top) for _ in range(width)] for _ in range(rows)], np.int64)
    want = y.astype(object).T @ y.astype(object)
    assert (whitening.cross_products(y) == want).all()


def test_scatter_in_parts_equals_whole():
    x = np.random.default_rng(2).integers(-500, 500, (300, 4)) + whitening.OFFSET
    whole, parts = whitening.Scatter(4), whitening.Scatter(4)
    whole.add(x)
    for at in (0, 17, 200):
        parts.add(x[at : {0: 17, 17: 200, 200: 300}[at]])
    z = (x - whitening.OFFSET).astype(object)
    assert whole.n == parts.n == 300 and (whole.cross == parts.cross).all() and (whole.cross == z.T @ z).all()
    assert (whole.sums == z.sum(axis=0)).all() and (whole.sums == parts.sums).all()


def test_whiten_equals_brute_force(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    got = whitening.op13(spark, SF).collect()
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert len(got) == 32 * len(rows)
    _check(got, rows)


def test_whiten_odd_rows(spark):
    rng = random.Random(8)
    good = [(i, [rng.uniform(-3, 3) for _ in range(5)]) for i in range(40)] + [(99, [2.5e3, -1.0, 0.0, 0.5, 7.0])]
    odd = [(100, None), (101, [float("nan")] * 5), (102, [1.0, None, 0.0, 0.0, 0.0]), (103, [float("-inf"), 0.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(good + odd, "vec_id long, embedding array<double>")
    df = df.withColumn("component", F.lit("x")).withColumn("x", F.lit(0)).withColumn("whitened", F.lit(1))
    got = whitening.whiten(whitening.finite_vectors(df)).collect()
    assert {r.component for r in got} == {1, 2, 3, 4, 5}
    _check(got, good)
    # rows that repeat, a null id, a short vector, and a constant dimension without a component of its own
    rows = [(1, [0.5, 1.0, 2.0]), (1, [0.5, 1.0, 2.0]), (None, [1.0, 3.0, 2.0]), (2, [0.0, 1.0, 2.0])]
    got = whitening.whiten(whitening.finite_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))).collect()
    assert {r.n for r in got} == {4} and {r.component for r in got} == {1, 2} and len(got) == 8
    short = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0]), (3, [2.0, 5.0]), (4, [])], "vec_id long, embedding array<double>")
    full = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [2.0, 5.0]), (4, [0.0, 0.0])], "vec_id long, embedding array<double>")
    a, b = (sorted((r.vec_id, r.component, r.deviation, round(abs(r.whitened), 9)) for r in
                   whitening.whiten(whitening.finite_vectors(d)).collect()) for d in (short, full))
    assert a == b
    for same in ([], [(1, [0.5, 1.0])], [(1, [0.5, 1.0]), (2, [0.5, 1.0])], [(1, [])], [(1, None)]):
        d = spark.createDataFrame(same, "vec_id long, embedding array<double>")
        assert whitening.whiten(whitening.finite_vectors(d)).count() == 0


def test_deviation_beyond_64_bits():
    w = whitening.Whitening(1 << 30, [0, 5], np.ones(1), np.ones((2, 1)), 1.0)
    d = whitening._centred(np.array([[whitening.OFFSET + 3, whitening.OFFSET], [whitening.OFFSET + (1 << 40), 0]]), w)
    assert whitening._deviation(d[:1]) == [(3 << 30) ** 2 + 25] if (3 << 30) ** 2 + 25 < 1 << 63 else [None]
    assert whitening._deviation(d)[1] is None
