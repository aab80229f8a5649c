"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]
and print one JSON line.

Each query runs to completion into Spark's ``noop`` sink (the whole plan
executes, nothing is collected to the driver).  ``BENCH_ALL=1`` times every
registered query instead of the headline set; ``BENCH_QUERIES=a,b`` times the
named ones.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from webledger.plans.registry import all_queries  # noqa: E402
from webledger.session import build_session  # noqa: E402

HEADLINE = [
    "c1_estimate_cost",
    "c5_spend_rollup",
    "c6_budget_status",
    "c10_allocate_budget",
    "c11_credits_per_success",
    "c14_tool_adoption",
    "k1_cache_lookup",
    "k2_replay_cache",
    "k5_dedupe_batch",
    "r1_rank_keys",
    "r8_burn_down",
    "e1_extract_distinct",
    "e3_extract_markdown",
    "e10_scrape",
    "d3_crawl",
    "d5_dedupe_similar_urls",
    "d6_crawl_status",
    "q1_search",
    "m1_diff_captures",
    "m2_diff_lines",
    "n7_missed_checks",
    "t1_spend_windows_sliding",
    "t2_interact_sessions",
    "p1_parse_documents",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus), app="webledger-bench")
    # Warm-up, not timed: JVM classes, the Parquet reader and codegen.
    spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").groupBy("event_type").count().collect()

    queries = all_queries()
    chosen = os.environ.get("BENCH_QUERIES")
    if chosen:
        names = [n.strip() for n in chosen.split(",") if n.strip()]
    else:
        names = sorted(queries) if os.environ.get("BENCH_ALL") == "1" else HEADLINE
    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)

    cps = (
        queries["c11_credits_per_success"](spark, sf_dir).where("tool is null").first()["credits_per_success"]
    )
    total = round(sum(times.values()), 3)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": total,
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf_dir,
        "cpus": cpus,
        "credits_per_success": cps,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
