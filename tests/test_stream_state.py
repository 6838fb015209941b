import os
import random
import shutil
import statistics
import tempfile
import time

import numpy as np
import pytest
from builders import BASE_US, alerts, trades
from paths import SF
from pyspark.sql import functions as F

from candlewick.operators import alerts as A
from candlewick.operators import detect, views
from candlewick.sinks import unique
from candlewick.sinks.unique import UniqueTable
from candlewick.sinks.versions import Commit, State, VersionedTable
from candlewick.streaming import carried, jobs

NOW = {"availableNow": True}


def _tmp():
    return tempfile.mkdtemp(prefix="cw-test-")


# --- versioned tables ---------------------------------------------------------

def _kv(spark, rows):
    return spark.createDataFrame(rows, "k string, v int, deleted boolean")


def _rows(df):
    return sorted((r.k, r.v) for r in df.collect())


def test_versions_merge_on_read_and_tombstones(spark):
    t = VersionedTable(spark, _tmp() + "/t", ["k"])
    assert t.read() is None and t.commit() is None
    a = t.write(0, _kv(spark, [("a", 1, False), ("a", 2, False), ("b", 1, False)]), None)
    b = t.write(1, _kv(spark, [("a", 3, False), ("c", 1, False)]), a)  # all rows of a key are replaced
    t.write(2, _kv(spark, [("b", None, True)]), b)
    assert _rows(t.read()) == [("a", 3), ("c", 1)]
    assert _rows(t.read(b)) == [("a", 3), ("b", 1), ("c", 1)] and _rows(t.read(a)) == [("a", 1), ("a", 2), ("b", 1)]
    assert t.write(1, _kv(spark, [("z", 9, False)]), Commit(-1, 2)) == Commit(-1, 2)  # a replayed batch changes nothing
    assert _rows(t.read()) == [("a", 3), ("c", 1)]


def test_readers_never_see_part_of_a_batch_or_fewer_keys(spark):
    path = _tmp() + "/t"
    s = State(spark, path, ["k"], compact_every=3)
    seen = []
    for n in range(7):
        reader = VersionedTable(spark, path, ["k"])
        before = reader.commit()
        early = reader.read(before) if before else None
        # a batch that was begun and not committed stays invisible, and its replay overwrites it
        _kv(spark, [("half", n, False)]).write.mode("overwrite").parquet(f"{path}/data/kind=delta/batch={n}")
        if before:
            assert _rows(VersionedTable(spark, path, ["k"]).read()) == seen
        s.write(n, _kv(spark, [(f"k{n}", n, False), ("same", n, False)]))
        if early is not None:  # planned before the batch, its compaction and the vacuum, run after them
            assert _rows(early) == seen
        seen = sorted([(f"k{m}", m) for m in range(n + 1)] + [("same", n)])
        assert _rows(VersionedTable(spark, path, ["k"]).read()) == seen
    assert VersionedTable(spark, path, ["k"]).commit() == Commit(5, 6)
    left = sorted(os.listdir(f"{path}/data/kind=delta"))
    assert "batch=0" not in left and "batch=6" in left and sorted(os.listdir(f"{path}/data/kind=base")) == ["batch=2", "batch=5"]
    again = State(spark, path, ["k"])
    assert again.has(6) and not again.has(7)


# --- insert if absent ---------------------------------------------------------

def test_bloom_has_no_false_negatives_and_few_hits():
    rng = np.random.default_rng(1)
    h1, h2 = rng.integers(-(1 << 63), 1 << 63, (2, 20_000))
    data = unique.bloom(h1[:10_000], h2[:10_000])
    assert unique.may_hold(data, h1[:10_000], h2[:10_000]).all()
    assert unique.may_hold(data, h1[10_000:], h2[10_000:]).sum() <= 2


def _ids(df):
    return sorted(r.id for r in df.collect())


def test_insert_reads_no_target_file_without_conflicts(spark):
    path = _tmp() + "/t"
    t = UniqueTable(spark, path, "id", "day")

    def batch(ids, day="2024-01-01"):
        return spark.createDataFrame([(str(i), day, i) for i in ids], "id string, day string, v int").withColumn("day", F.to_date("day"))

    t.insert(0, batch([*range(300), 5]))
    t.insert(1, batch(range(1000, 1300), "2024-01-02"))
    assert len(_ids(t.read())) == 600
    kept = {}
    for root, _, files in os.walk(path):
        for f in files:
            if f.endswith(".parquet"):
                p = os.path.join(root, f)
                kept[p] = open(p, "rb").read()
                open(p, "wb").write(b"unreadable")
    t.insert(2, batch(range(2000, 2300)))  # no file of the table can be read, and none needs to be
    with pytest.raises(Exception):
        t.insert(3, batch([3, 3000]))  # an exact look is needed for id 3
    for p, b in kept.items():
        open(p, "wb").write(b)
        crc = os.path.join(os.path.dirname(p), f".{os.path.basename(p)}.crc")
        if os.path.exists(crc):
            os.remove(crc)
    assert _ids(t.insert(3, batch([3, 3000]))) == ["3000"]
    assert _ids(t.insert(3, batch([3, 3000]))) == ["3000"]  # a replay
    assert _ids(t.insert(2, batch(range(2000, 2300)))) == sorted(map(str, range(2000, 2300)))
    assert _ids(t.insert(4, batch([1005], "2024-01-03"))) == []  # a day apart
    assert _ids(t.insert(5, batch([7], "2024-01-09"))) == ["7"]  # days apart: another row
    assert _ids(UniqueTable(spark, path, "id", "day", days=None).insert(6, batch([8], "2024-01-09"))) == []
    assert t.read().count() == 902 and _ids(t.insert(7, batch([]))) == []


# --- detector -------------------------------------------------------------------

def _walk(rng, n, symbols):
    return [(rng.choice(symbols), 100 * (1 + rng.choice([0, 0, 0.02, -0.04, 0.08, 0.2])), rng.choice([1, 2, 3, 15]), "BUY", k * 0.5)
            for k in range(n)]


def test_detector_equals_batch_at_every_split(spark):
    t = trades(spark, _walk(random.Random(4), 700, ["HOT"] * 9 + ["A", "B"])).persist()
    want = sorted(map(tuple, detect.alerts_from_stats(detect.rolling_stats(t)).select("alert_id", "u", "change_pct", "multiplier").collect()))
    assert len(want) > 100
    for cuts in ([3, 30, 420], [100, 101, 690]):
        state, got = State(spark, _tmp() + "/tail", ["symbol"]), []
        for n, (a, b) in enumerate(zip([0, *cuts], [*cuts, 700])):
            past = carried.with_tail(t.where(F.col("seq").between(a, b - 1)), state.read())
            got += carried.batch_alerts(past, bucket_us=20_000_000, chunk_rows=150).select("alert_id", "u", "change_pct", "multiplier").collect()
            state.write(n, carried.new_tail(past))
        assert sorted(map(tuple, got)) == want
        sizes = {r.symbol: r["count"] for r in state.read().groupBy("symbol").count().collect()}
        assert sizes["HOT"] == 100 and sizes["A"] <= 100


def test_hot_symbol_is_many_tasks(spark):
    rng = random.Random(2)
    rows = [("HOT" if rng.random() < 0.9 else f"S{rng.randrange(20)}", 100.0, 1.0, "BUY", k * 0.2) for k in range(24_000)]
    t = trades(spark, rows)
    tail = spark.createDataFrame([("HOT", k, 100.0, 1.0) for k in range(1, 101)], "symbol string, pos long, price double, quantity double")
    conf = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(conf, "false")
    try:
        stats = detect.rolling_stats(carried.with_tail(t, tail), bucket_us=20_000_000, chunk_rows=250)
        # counting the averages keeps the windows in the plan
        per_task = [r.n for r in stats.groupBy(F.spark_partition_id().alias("p")).agg(F.count("avg_price").alias("n")).collect()]
    finally:
        spark.conf.set(conf, "true")
    assert len(per_task) == 8 and max(per_task) < 2 * statistics.median(per_task)


# --- alert engine -----------------------------------------------------------------

def test_engine_equals_batch_at_every_split(spark):
    rng = random.Random(7)
    kinds = ["PRICE_SPIKE", "CIRCUIT_BREAKER", "VOLUME_SPIKE", "OTHER"]
    rows = sorted(((rng.choice(kinds), rng.choice(["A", "A", "B"]), rng.randrange(0, 4000)) for _ in range(260)), key=lambda r: r[2])
    raw = alerts(spark, rows).persist()
    cols = ["alert_id", "severity", "original_severity", "breaker_state"]
    want = sorted(map(tuple, A.alerts_final(raw).select(cols).collect()))
    assert {w[3] for w in want} == {"CLOSED", "OPEN", "HALF_OPEN"}
    for cuts in ([1, 130], [60, 61, 200]):
        state, got = State(spark, _tmp() + "/kept", A.KEYS), []
        for n, (a, b) in enumerate(zip([0, *cuts], [*cuts, 260])):
            # alerts of one instant may be cut apart: the later ones are suppressed by the earlier
            final = carried.batch_final(raw.where(F.col("seq").between(a, b - 1)), state.read()).persist()
            got += final.select(cols).collect()
            old = state.read()
            state.write(n, carried.new_kept(final))
            assert old is None or state.read().count() >= old.count()
        assert sorted(map(tuple, got)) == want


# --- views, expiry, counters --------------------------------------------------------

def _append(df, src):
    df.coalesce(1).write.mode("append").parquet(src)
    time.sleep(0.05)


def test_silent_symbol_loses_views_and_counter(spark):
    root, h = _tmp(), 3600
    src, out = root + "/in", root + "/views"
    both = [(s, 100 + k, 1, "BUY", k) for k in range(5) for s in ("A", "B")]
    batches = [both, [("B", 200, 1, "BUY", h - 10)], [("B", 201, 1, "SELL", h + 5)], [("B", 202, 1, "BUY", 24 * h + 3)],
               [("B", 203, 1, "BUY", 24 * h + 4)], [("A", 300, 2, "BUY", 25 * h)]]
    seen = []
    for k, rows in enumerate(batches):
        df = trades(spark, rows).withColumn("trade_id", F.concat(F.lit(f"{k}-"), "trade_id"))
        _append(df, src)
        jobs.run_views(jobs.file_source(spark, src, df.schema), out, root + "/ck", NOW).awaitTermination()  # restarts each time
        live = {v: {r.symbol for r in jobs.read_view(spark, out, v).collect()} for v in ("price", "trades", "series")}
        assert live["price"] == live["trades"] == live["series"]
        seen.append((sorted(live["price"]), {r.symbol: r.n for r in jobs.read_view(spark, out, "counts").collect()}))
    assert seen == [(["A", "B"], {"A": 5, "B": 5}), (["A", "B"], {"A": 5, "B": 6}), (["B"], {"A": 5, "B": 7}), (["B"], {"A": 5, "B": 8}),
                    (["B"], {"B": 9}), (["A", "B"], {"A": 1, "B": 9})]
    ring = [(r.symbol, r.price) for r in jobs.read_view(spark, out, "trades").collect()]
    assert sorted(ring) == [("A", 300.0), ("B", 202.0), ("B", 203.0)]  # nothing from before a silence comes back


def test_series_keeps_newest_members_with_new_scores(spark, monkeypatch):
    monkeypatch.setitem(carried.VIEW_ROWS, "series", 5)
    rows = [("A", p, 1, "BUY", t) for p, t in [(1, 0), (2, 1), (2, 1), (3, 2), (4, 3), (5, 4)]]
    first = trades(spark, rows)
    runs = carried.runs_and_gone(first, None, 3600)
    view = carried.new_view("series", first, None, runs).drop("deleted").persist()
    assert sorted(r.price for r in view.collect()) == [1, 2, 3, 4, 5]
    # the member (2, second 1) again, as a later arrival at the same instant, and two new ones
    late = trades(spark, [("A", 2, 1, "BUY", 1), ("A", 6, 1, "BUY", 5), ("A", 7, 1, "BUY", 6)]).withColumn("seq", F.col("seq") + 100)
    runs = carried.runs_and_gone(late, runs.drop("deleted"), 3600)
    got = {r.price: r.seq for r in carried.new_view("series", late, view, runs).collect()}
    both = first.unionByName(late)
    want = {r.price: r.seq for r in carried._newest(carried._members("series", both), 5).collect()}
    assert got == want and set(got) == {3, 4, 5, 6, 7}


def test_counters_of_a_restarted_stream_count_each_batch_once(spark):
    root = _tmp()
    src = root + "/in"
    t = trades(spark, _walk(random.Random(3), 400, ["A", "B"]))
    for a in (0, 150):
        _append(t.where(F.col("seq").between(a, a + 149)), src)
        jobs.run_detect(jobs.file_source(spark, src, t.schema), root + "/raw", root + "/ck", NOW, root + "/counters").awaitTermination()
    _append(t.where("seq >= 300"), src)
    for name in ("ck", "raw__tail"):
        shutil.copytree(f"{root}/{name}", f"{root}/{name}-before")
    stream = jobs.file_source(spark, src, t.schema)
    jobs.run_detect(stream, root + "/raw", root + "/ck", NOW, root + "/counters").awaitTermination()
    # the same batch again, as after a loss before its end: its folders are written, its state is not
    os.rename(root + "/raw__tail", root + "/raw__tail-after")
    os.rename(root + "/raw__tail-before", root + "/raw__tail")
    jobs.run_detect(stream, root + "/raw", root + "/ck-before", NOW, root + "/counters").awaitTermination()
    got = {(r.counter, r.label): r.value for r in jobs.read_counters(spark, root + "/counters").collect()}
    assert got["trades_by_symbol", "A"] + got["trades_by_symbol", "B"] == 400
    made = detect.alerts_from_stats(detect.rolling_stats(t)).groupBy("alert_type", "severity").count().collect()
    assert {k[1]: v for k, v in got.items() if k[0] == "alerts_generated"} == {f"{r.alert_type}:{r.severity}": r["count"] for r in made}


def test_latest_run_goes_on_over_carried_rows(spark):
    rng = random.Random(5)
    at = sorted(rng.sample(range(40_000), 60))
    t = trades(spark, [(rng.choice("AB"), 1, 1, "BUY", k) for k in at])
    whole = sorted(map(tuple, views.latest_run(t, 1200).collect()))
    run = None
    for a, b in ((0, 20), (20, 23), (23, 60)):
        run = views.latest_run(t.where(F.col("seq").between(a, b - 1)), 1200, run).persist()
    assert sorted(map(tuple, run.collect())) == whole and BASE_US <= whole[0][2]


def test_registered_views_equal_batch_on_small_table(spark):
    from candlewick.plans.queries import QUERIES
    got = QUERIES["stream_trade_counts"](spark, SF)
    want = QUERIES["trade_counts"](spark, SF)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
