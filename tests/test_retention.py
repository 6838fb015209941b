import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from candlewick.functions.timecols import epoch_micros, ntz_from_micros
from candlewick.sinks import retention
from candlewick.sinks.unique import UniqueTable

DAY_US = 86_400_000_000
REF = 19_800 * DAY_US + 5_000_000  # five seconds into a day


def _rows(spark, hours):
    data = [(f"t{h}", REF - h * 3_600_000_000) for h in hours]
    df = spark.createDataFrame(data, "trade_id string, u long").withColumn("ts", ntz_from_micros("u"))
    return df.withColumn("trade_date", F.to_date("ts"))


def _ids(df):
    return sorted(int(r.trade_id[1:]) for r in df.select("trade_id").collect())


def test_whole_days_go_and_the_horizon_is_exact(spark):
    root = tempfile.mkdtemp(prefix="cw-test-") + "/t"
    hours = list(range(0, 34 * 24, 6))
    assert retention.drop_expired(spark, root, "trade_date", REF) == []  # no table yet
    t = UniqueTable(spark, root, "trade_id", "trade_date")
    t.insert(0, _rows(spark, hours[::2]))
    t.insert(1, _rows(spark, hours[1::2]))  # days below two folders of batches
    assert retention.newest(t.read(), "trade_date", "ts") == REF
    before = _ids(retention.retained(t.read(), "trade_date", "ts", REF))
    assert before == [h for h in hours if h <= 30 * 24]
    gone = retention.drop_expired(spark, root, "trade_date", REF)
    first = dt.date(1970, 1, 1) + dt.timedelta(days=19_800 - 30)
    assert gone == [first - dt.timedelta(days=k) for k in (4, 3, 2, 1)]
    left = {d for b in os.listdir(root) if b.startswith("batch=") for d in os.listdir(f"{root}/{b}") if d.startswith("trade_date=")}
    assert min(left) == f"trade_date={first}"
    assert _ids(retention.retained(t.read(), "trade_date", "ts", REF)) == before
    assert retention.drop_expired(spark, root, "trade_date", REF) == []  # again
    t.insert(2, _rows(spark, [1, 6]))  # the table goes on; 6 is there already
    assert _ids(retention.retained(t.read(), "trade_date", "ts", REF)) == sorted([*before, 1])


def test_reader_opens_retained_days_only(spark):
    root = tempfile.mkdtemp(prefix="cw-test-") + "/t"
    _rows(spark, range(0, 40 * 24, 12)).write.partitionBy("trade_date").parquet(root)
    kept = retention.retained(spark.read.parquet(root), "trade_date", "ts", REF, 2 * 86_400)
    assert len(kept.select(F.input_file_name().alias("f")).distinct().collect()) <= 4 * 3
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(trade_date" in plan and "GreaterThanOrEqual(ts" in plan
    assert kept.agg(F.min(epoch_micros("ts"))).head()[0] >= REF - 2 * DAY_US


def test_null_day_and_empty_table(spark):
    root = tempfile.mkdtemp(prefix="cw-test-") + "/t"
    rows = _rows(spark, [0, 2000]).withColumn("trade_date", F.when(F.col("trade_id") == "t0", F.col("trade_date")))
    rows.write.partitionBy("trade_date").parquet(root)
    assert retention.drop_expired(spark, root, "trade_date", REF) == []  # the day of the old row is not known
    assert spark.read.parquet(root).count() == 2
    empty = _rows(spark, [0]).limit(0)
    assert retention.newest(empty, "trade_date", "ts") is None
    assert retention.retained(empty, "trade_date", "ts", REF).count() == 0
