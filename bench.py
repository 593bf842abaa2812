"""Benchmark: headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Each query is executed in full (``write.format("noop")``: every row is
produced, nothing is collected to the driver) after one warm-up run of
the flagship on the same data. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "traffic_vc_ch_ar_isnew",   # A1 flagship: F1 + F2 + 10 s window
    "order_detail_fact",        # J1: upsert view + 3 joins
    "payment_interval_join",    # J3: bucketed interval join + lookup
    "province_order_window",    # A2: retraction + window + enrichment
    "sku_order_window",         # A3: retraction + window + six-level chain
    "cart_uu_window",           # A4: first-of-day + window
    "home_detail_uv_window",    # A5
    "user_login_window",        # A6
    "keyword_window",           # A7: search filter + tokenizer + 1 s window
    "routed_facts",             # P5 + P7: config-driven routing
    "dim_apply",                # P6 + K6: dimension merge
    "age_level",                # J14 + M1-M7: profile join and scores
    "moderation_report",        # J11 + F9 + T2 + T3
    "cdc_scan",                 # S1: raw change-log parse
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    from emporia.plans import QUERIES
    from emporia.session import get_session

    spark = get_session(f"local[{cpus}]", app="emporia-bench", shuffle_partitions=max(8, 2 * cpus))
    QUERIES["traffic_vc_ch_ar_isnew"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
