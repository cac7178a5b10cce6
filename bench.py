"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full with the no-op sink (every row is produced,
nothing is collected), after one warm-up query. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from martforge.plans.registry import QUERIES  # noqa: E402
from martforge.session import build_session  # noqa: E402

HEADLINE = [
    "clean_customers", "clean_orders", "clean_products", "clean_order_items",
    "dim_customers", "dim_products", "dim_date", "fact_orders", "reject_facts",
    "audit_star", "profile_nulls", "order_revenue", "iqr_outliers",
    "upsert_customers", "fact_refresh", "end_to_end_summary",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(app="martforge-bench")
    QUERIES["dim_date"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    times = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "total_seconds_headline_queries", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
