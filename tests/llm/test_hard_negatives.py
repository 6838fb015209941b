import random

import duckdb
import numpy as np
from paths import SF

from candlewick.llm import hard_negatives as hn
from pyspark.sql import functions as F


def _brute(rows, anchors, n_pos=5, n_neg=10):
    """rows: (vec_id, label, v); anchors: places in rows -> sorted result rows"""
    width = max((len(v) for _, _, v in rows), default=0)
    x = [np.array(list(v) + [0] * (width - len(v)), object) for _, _, v in rows]
    out = []
    for a in anchors:
        score = [int((x[a] * y).sum()) for y in x]
        order = sorted((k for k in range(len(rows)) if k != a), key=lambda k: (-score[k], rows[k][0], k))
        for p in [k for k in order if rows[k][1] == rows[a][1]][:n_pos]:
            fits = [k for k in order if rows[k][1] != rows[a][1] and 30 * score[p] <= 100 * score[k] <= 90 * score[p]]
            out += [(rows[a][0], rows[p][0], r + 1, rows[k][0], score[p], score[k]) for r, k in enumerate(fits[:n_neg])]
    return sorted(out)


def _mined(df, anchors, **kw):
    cols = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in hn.mine(df, anchors, **kw).select(cols).collect())


def test_intervals_hold_the_scores_and_prune():
    con = duckdb.connect()
    v = np.array(con.sql("SELECT embedding FROM '/root/testdata/sf0.1/embeddings.parquet'").fetchnumpy()["embedding"].tolist())
    v = np.floor(256 * v.astype(float)).astype(np.int64)
    turn = hn.rotation(64)
    codes = hn.encode(v, turn)
    share = []
    for a in range(0, 2000, 100):
        low, high = hn.intervals(codes, v[a], turn)
        s = v @ v[a]
        assert (low <= s).all() and (s <= high).all()
        share.append(hn.may_be_best(low, high, 6).mean())
        top = int(np.sort(s)[-6])
        may = hn.may_be_negative(low, high, top, 10)
        fits = np.flatnonzero((30 * top <= 100 * s) & (100 * s <= 90 * top))
        assert may[fits[np.argsort(-s[fits], kind="stable")[:10]]].all()
        share.append(may.mean())
    assert np.mean(share) < 0.15  # the others are never scored
    one = hn.encode(v, turn, 1)  # a single level is right as well, but wide
    low, high = hn.intervals(one, v[0], turn)
    assert (low <= v @ v[0]).all() and (v @ v[0] <= high).all()


def test_mine_equals_brute_force_on_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(hn, "LEAST", 7)  # several blocks of a label
    rng = random.Random(6)
    rows = [(k, rng.choice([0, 0, 0, 1, 2, 3]), [rng.randint(-4, 4) for _ in range(3)]) for k in range(120)]  # many ties
    rows += [(200, 9, [1, 1, 1]), (300, 1, []), (301, 2, [5]), (302, 1, [0, 0, 0]), (20, 1, [3, 3, 3]), (40, 3, [3, 3, 3])]
    rows += rows[:6]  # equal rows
    extra = [(None, 1, [1, 1, 1]), (500, None, [1, 1, 1])]
    df = spark.createDataFrame([r + ("x", 1) for r in rows + extra], "vec_id long, label int, v array<long>, anchor string, cell int")
    anchors = [k for k, r in enumerate(rows) if r[0] % 20 == 0]
    want = _brute(rows, anchors)
    assert len(want) > 100 and _mined(df.repartition(4), F.col("vec_id") % 20 == 0) == want
    assert _mined(df, F.col("vec_id") % 20 == 0, positives=2, negatives=3) == _brute(rows, anchors, 2, 3)
    assert hn.mine(df.limit(0), F.lit(True)).count() == 0
    assert hn.mine(df, F.lit(False)).count() == 0
    assert hn.mine(df.where("label = 9"), F.lit(True)).count() == 0  # one row alone


def test_relabelled(spark):
    rows = [(7, 9, [0.5, -0.001]), (8, 9, [1.0, 2.0]), (9, None, [1.0]), (10, 1, None), (11, 1, [float("nan")]), (12, 1, [None]),
            (13, 1, [float("-inf")]), (14, 3, [])]
    got = {r.vec_id: (r.label, r.v) for r in hn.relabelled(
        spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").withColumn("v", F.lit(3))).collect()}
    assert got == {7: (0, [128, -1]), 8: (9, [256, 512]), 14: (4, [])}


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    want = con.execute(f"SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ({hn.SQL})").fetchall()
    assert sorted(tuple(r) for r in hn.op12(spark, SF).collect()) == sorted(want) and want
