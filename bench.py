"""Bench: headline queries on $BENCH_SF_DIR (default sf0.1) on local[$BENCH_CPUS].

Each query runs to completion through Spark's `noop` sink (every row computed,
nothing collected to the driver); the reported time is the best of
$BENCH_REPEAT runs after one warm-up run of the same plan. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
REPEAT = int(os.environ.get("BENCH_REPEAT", "2"))


def headline():
    from barwright.plans import queries as q

    return {
        "bars_30m": q.q_bars_30m,
        "orderflow_continuous": q.q_orderflow_continuous,
        "orderflow_daily": q.q_orderflow_daily,
        "klines_clean": q.q_klines_clean,
        "day_completeness": q.q_day_completeness,
        "quality_summary": q.q_quality_summary,
        "ind_bbands": q.QUERIES["ind_bbands"],
        "ind_macd": q.QUERIES["ind_macd"],
        "features_full": q.q_flagship,
        "features_dense": q.q_features_dense,
    }


def main() -> None:
    from barwright.session import get_spark

    spark = get_spark(master=f"local[{CPUS}]", shuffle_partitions=CPUS)
    times = {}
    rows = {}
    for name, fn in headline().items():
        best = None
        for i in range(REPEAT + 1):
            t0 = time.time()
            df = fn(spark, SF_DIR)
            df.write.format("noop").mode("overwrite").save()
            dt = time.time() - t0
            if i > 0:
                best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
        rows[name] = fn(spark, SF_DIR).count()
    sf = os.path.basename(SF_DIR.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "total_sec_headline_queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "rows": rows,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": CPUS,
        "repeat": REPEAT,
    }))


if __name__ == "__main__":
    main()
