"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the test-data folder, ``BENCH_CPUS`` the number of local cores. Every query
runs over its whole tables: one warm-up, then the median of three runs, plan building included.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from bazaarframe.session import local_session  # noqa: E402
from gate.queries import all_queries  # noqa: E402

HEADLINE = [
    "order_metrics",
    "monthly_sales",
    "category_performance",
    "customer_metrics",
    "seller_performance",
    "delivery_performance",
    "executive_kpis",
    "top_states",
    "delivery_summary",
    "review_by_lateness",
    "repeat_customers",
    "freight_impact",
    "console_report",
    "dash_kpis",
    "dash_monthly_filtered",
    "dash_cards",
    "dash_insights",
    "dq_orphan_items_orders",
    "dq_pk_duplicates",
    "profile_duplicates",
]
RUNS = 3


def run(spark, query, sf_dir: str) -> float:
    started = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "*"), "bazaarframe-bench")
    queries = all_queries()
    seconds = {}
    for name in HEADLINE:
        run(spark, queries[name], sf_dir)
        seconds[name] = round(statistics.median(run(spark, queries[name], sf_dir) for _ in range(RUNS)), 3)
    spark.stop()
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(scale.group(1)) if scale else sf_dir,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
