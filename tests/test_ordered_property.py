"""Skew-safe ordered helpers vs brute force on random data with a hot key."""
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from candlewick.functions.numeric import dec
from candlewick.functions.ordered import ordinal_rank, prefix_max_before, rolling_previous

rows_strategy = st.lists(
    st.tuples(st.sampled_from(["HOT", "HOT", "HOT", "b", "c"]),  # one key holds most rows
              st.integers(min_value=0, max_value=50),           # coarse times: many ties
              st.integers(min_value=1, max_value=999)),
    min_size=1, max_size=120)


def _df(spark, rows):
    data = [(k, t * 1_000_000, i, v / 10.0) for i, (k, t, v) in enumerate(rows)]
    return spark.createDataFrame(data, "k string, u long, seq long, x double")


def _brute(rows, n):
    by = {}
    for i, (k, t, v) in enumerate(rows):
        by.setdefault(k, []).append((t * 1_000_000, i, v))
    out = {}
    for k, items in by.items():
        items.sort()
        for r, (u, i, v) in enumerate(items):
            prev = items[max(0, r - n):r]
            out[i] = (r + 1, sum(p[2] for p in prev), len(prev),  # x = v / 10, so 10 * sum(x) = sum(v)
                      max((p[0] for p in items[:r]), default=None))
    return out


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck),
          phases=[Phase.explicit, Phase.reuse, Phase.generate])
@given(rows=rows_strategy, bucket_s=st.sampled_from([1, 3, 7, 1000]), chunk=st.sampled_from([5, 8, 200]))
def test_rank_rolling_prefix_match_brute_force(spark, rows, bucket_s, chunk):
    n = 4
    df = _df(spark, rows)
    ranked = ordinal_rank(df, "k", bucket_us=bucket_s * 1_000_000)
    rolled = rolling_previous(ranked, "k", {"s": dec("x")}, n=n, chunk_rows=chunk)
    pm = prefix_max_before(rolled, "k", F.col("u"), "prev_u", bucket_us=bucket_s * 1_000_000)
    got = {r.seq: (r.rk, round(float(r.s) * 10), r.n_prior, r.prev_u) for r in pm.collect()}
    assert got == _brute(rows, n)
