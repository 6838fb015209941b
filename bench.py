"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]
and print ONE JSON line.

Each query is forced to completion with the ``noop`` sink (full execution,
no driver collect). One cold run, then the median of ``BENCH_RUNS`` warm runs.
"""
from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from candlewick.plans.queries import QUERIES  # noqa: E402
from candlewick.session import build_session  # noqa: E402

HEADLINE = [
    "ohlcv_1m", "ohlcv_all", "last_closed_candle", "latest_price", "recent_trades", "trade_counts",
    "rolling_stats", "alerts_raw", "alerts_final", "alert_counts", "market_summary", "top_movers", "pressure",
    "trades_clean", "latency_quantiles", "price_levels",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    n_trades = spark.read.parquet(os.path.join(sf_dir, "events.parquet")).count()
    out: dict[str, float] = {}
    for name in names:
        fn = QUERIES[name]
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()  # cold
        times = []
        for _ in range(runs):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - t0)
        out[name] = round(statistics.median(times), 3)
        print(f"# {name}: {out[name]:.3f}s ({n_trades / out[name]:,.0f} trades/s)", file=sys.stderr)
    total = round(sum(out.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_sec", "value": total, "unit": "sec", "queries": out,
                      "sf": float(sf) if sf.replace(".", "").isdigit() else sf, "trades": n_trades,
                      "trades_per_sec": round(n_trades * len(out) / total, 1) if total else None}))
    spark.stop()


if __name__ == "__main__":
    main()
