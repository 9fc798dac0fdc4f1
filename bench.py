"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line: {"metric", "value", "unit", "queries", "sf"}.
Each query is executed in full with the no-op sink (every row is
computed, nothing is collected), after a trivial warm-up job.  All queries
share one run context, as the stages of the reference share one warehouse:
the first query that needs a fact builds and keeps it (its time is counted
there), later queries reuse it, and marts are materialised once at their
stage boundary.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "fc05_session_fact",
    "fc03_search_fact",
    "pm03_daily_metrics",
    "pm06_partner_performance",
    "pm11_product_segments",
    "pm08_retention",
    "pg04_partner_activation",
    "pg10_partner_opportunities",
    "in11_check_table",
    "ex08_primary_effect",
    "ex10_cuped",
    "ex12_guardrails",
    "ex14_segment_effects_fdr",
    "nw04_pagerank",
    "nw07_betweenness",
    "nw11_route_scores",
    "nw13_partner_route_scores",
    "an07_daily_anomalies",
    "an09_primary_driver",
    "an10_top_partner_context",
    "ml02_model_frame",
    "ml10_ranking_metrics",
    "ml16_calibration",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from kestrel.plans.registry import load_all
    from kestrel.session import get_spark

    spark = get_spark(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2, app_name="kestrel-bench")
    reg = load_all()
    spark.range(1000).selectExpr("sum(id)").collect()   # warm-up: JVM and code paths only, no test data
    times = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        reg[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
