"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local threads, BENCH_QUERIES (comma
separated) another set of queries. Each query is planned and run twice, and the faster run
counts: the first one also pays for code generation and Python workers.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sparkmart.plans.catalog import all_queries  # noqa: E402
from sparkmart.session import build_session  # noqa: E402

HEADLINE = [
    "q_brand_revenue",
    "q_product_revenue",
    "q_top_products",
    "q_monthly_revenue",
    "q_discount_impact",
    "q_discount_summary",
    "q_event_revenue",
    "q_feature_join",
    "q_features_products",
    "q_ingest_incremental",
    "q_mann_whitney",
    "q_hypothesis_test",
    "q_ab_test",
    "q_cosine_topk",
    "q_scan_compare",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, seconds = all_queries(), {}
    for name in names:
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            queries[name].run(spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
