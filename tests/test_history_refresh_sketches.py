import tempfile

import numpy as np
from builders import BASE_US, trades
from pyspark.sql import functions as F

from candlewick.functions.timecols import ntz_from_micros
from candlewick.operators import candles, history, metrics, views
from candlewick.sinks.minute_candles import MinuteCandles

DAY = 86_400


def _tmp():
    return tempfile.mkdtemp(prefix="cw-test-")


def test_trade_a_day_late_shows_and_untouched_minutes_are_not_recomputed(spark):
    t = trades(spark, [("AAPL", 100 + k % 7, 1, "BUY", 600 * k) for k in range(300)])  # over three dates
    table = MinuteCandles(spark, _tmp())
    table.load_all(0, t)
    late = trades(spark, [("AAPL", 500, 3, "SELL", 600 * 20 + 5), ("MSFT", 7, 1, "BUY", 600 * 20 + 9)]).withColumn("seq", F.col("seq") + 1000)
    table.log(1, late)
    wrong = t.withColumn("price", F.lit(1.0)).unionByName(late)  # shows which minutes a refresh recomputes
    table.refresh(1, wrong, BASE_US + 600 * 299 * 1_000_000)
    got = {(r.symbol, r.bucket): (r.close_price, r.trade_count) for r in table.read().collect()}
    assert len(got) == 301
    at = (t.where("seq = 20").head().ts.replace(second=0, microsecond=0))
    assert got["AAPL", at] == (500.0, 2) and got["MSFT", at] == (7.0, 1)
    changed = sum(p == (1.0, 1) for p in got.values())
    assert changed == 1  # of the range of ten minutes; the late trade's minute has the late price
    table.refresh(2, wrong, BASE_US + 600 * 299 * 1_000_000)  # the log of load 1 is spent
    assert table.table.versions(table.table.commit()).where("batch = 2").count() == 1
    before = table.read().count()
    table.refresh(2, wrong.limit(0).unionByName(t), BASE_US)  # a number that is in changes nothing
    assert table.read().count() == before
    assert MinuteCandles(spark, _tmp()).read() is None


def test_refresh_equals_full_recomputation(spark):
    t = trades(spark, [(s, 100 + (k * 7) % 11, 1, "BUY", 37 * k) for k in range(200) for s in ("A", "B")]).persist()
    table, ref = MinuteCandles(spark, _tmp()), None
    for n, cut in enumerate((90, 180, 400)):
        seen, new = t.where(F.col("seq") < cut), t.where(F.col("seq").between({90: 0, 180: 90, 400: 180}[cut], cut - 1))
        table.log(n, new)
        ref = new.agg(F.max("u")).head()[0]
        if n == 0:
            table.load_all(n, seen)
        else:
            table.refresh(n, seen, ref + 120_000_000)
    want = candles.candles_1min_view(t)
    got = table.read().select(want.columns)
    assert want.exceptAll(got).union(got.exceptAll(want)).count() == 0


def test_far_page_sorts_no_more_than_a_page_of_rows(spark):
    n = 2_100_000
    t = spark.range(n).select(F.col("id").cast("string").alias("trade_id"), F.concat(F.lit("S"), F.col("id") % 3).alias("symbol"),
                              F.lit(1.0).alias("price"), F.lit(2.0).alias("quantity"), F.lit("BUY").alias("side"), F.lit("X").alias("exchange"),
                              (F.lit(BASE_US) + F.col("id") * 50_000).alias("u"), F.col("id").alias("seq"))
    t = t.withColumn("ts", ntz_from_micros("u"))
    index = history.count_index(t).persist()
    first, last, skip = history.seek(t, index, 100, 2_000_000)
    assert skip < 100 and t.where(F.col("u").between(first, last)).count() <= 300
    got = [int(r.trade_id) for r in views.trade_history(t, limit=100, offset=2_000_000, index=index).collect()]
    assert got == list(range(n - 2_000_001, n - 2_000_101, -1))
    own = [int(r.trade_id) for r in views.trade_history(t, " s1", 5, 600_000, index).collect()]
    assert own == [x for x in range(n - 1, n - 1_800_100, -1) if x % 3 == 1][600_000:600_005]
    assert views.trade_history(t, limit=10, offset=n - 4, index=index).count() == 4
    assert views.trade_history(t, limit=10, offset=n, index=index).count() == 0


def test_pages_with_many_trades_at_one_instant(spark):
    t = trades(spark, [("A", k, 1, "BUY", 0 if k < 60 else k // 20) for k in range(200)])
    order = [r.trade_id for r in t.orderBy(F.desc("u"), F.desc("seq")).collect()]
    for offset, limit in ((1, 7), (130, 30), (150, 60), (199, 5), (0, 10)):
        assert [r.trade_id for r in views.trade_history(t, limit=limit, offset=offset).collect()] == order[offset : offset + limit]


def test_sketch_quantiles_are_within_a_rank_error(spark):
    rng = np.random.default_rng(2)
    lat = np.concatenate([rng.lognormal(7, 1, 12_000), rng.integers(1, 400, 8_000)]).astype(int)
    rows = [(["A", "B", "C"][k % 3], 1, 1, "BUY", k * 0.06) for k in range(len(lat))]
    t = trades(spark, rows)
    t = t.drop("latency_us").join(spark.createDataFrame([(k, int(x)) for k, x in enumerate(lat)], "seq long, latency_us int"), "seq")
    stored = metrics.latency_sketches(t).persist()
    assert stored.count() == 3 * 20
    by_symbol = metrics.sketch_quantiles(metrics.merge_sketches(stored, None, ("symbol",))).collect()
    by_window = metrics.sketch_quantiles(metrics.merge_sketches(stored, 300)).collect()
    whole = metrics.sketch_quantiles(metrics.merge_sketches(stored)).collect()
    assert (len(by_symbol), len(by_window), len(whole)) == (9, 12, 3)
    second = np.arange(len(lat)) * 0.06
    for r in by_symbol + by_window + whole:
        own = np.sort(lat[np.arange(len(lat)) % 3 == "ABC".index(r.symbol)] if hasattr(r, "symbol") and "symbol" in r else
                      lat[second // 300 == (r.window_u - BASE_US) // 300_000_000] if "window_u" in r else lat)
        assert r.n == len(own)
        v = round(r.latency_s * 1e6)
        lo, hi = np.searchsorted(own, v, "left") / len(own), np.searchsorted(own, v, "right") / len(own)
        assert lo - 0.01 <= r.quantile <= hi + 0.01
