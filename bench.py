"""Benchmark: run the headline plans on $BENCH_SF_DIR (default sf0.1) on
local[$BENCH_CPUS] and print one JSON line with per-query seconds.

Each plan is executed in full with the ``noop`` sink (every row is
computed, nothing is collected to the driver).  A warm-up run per plan
loads classes and file metadata; the reported time is the best of
$BENCH_REPEAT timed runs.  $BENCH_CONF ("key=value,key=value") adds
session settings, for comparing configurations.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "top_products_revenue",
    "sales_by_country",
    "country_customers_orders",
    "revenue_by_category_quarter",
    "star_denormalized",
    "latest_order_items",
    "keyed_upsert",
    "validate_business_key",
    "orphan_counts",
    "quarantine_summary",
    "sessions_by_gap",
    "reconciliation",
    "dq_metrics",
    "envelope_roundtrip",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    names = sys.argv[1:] or HEADLINE
    from tessera.plans import load_all
    from tessera.session import build_session
    extra = dict(kv.split("=", 1) for kv in os.environ.get("BENCH_CONF", "").split(",") if "=" in kv)
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2, extra=extra)
    plans = load_all()
    timings = {}
    for name in names:
        fn = plans[name][0]
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
        best = None
        for _ in range(repeat):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        timings[name] = round(best, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(timings.values()), 3), "unit": "sec",
                      "queries": timings, "sf": float(sf) if sf.replace(".", "").isdigit() else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
