"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR   data folder (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default: all)
BENCH_QUERIES  comma-separated names, or "all" (default: the headline set)
BENCH_RUNS     timed runs per query after one warm-up (default 2); the median counts
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from lanewise.catalog import QUERIES
from lanewise.session import local_session

HEADLINE = [
    "signed_balance",
    "group_min_max",
    "count_distinct",
    "duplicate_keys",
    "pivot_sum",
    "join_null_full",
    "missing_dates_anti",
    "missing_numbers",
    "running_total_by_key",
    "running_total_overall",
    "moving_avg_6",
    "dense_rank_desc",
    "three_in_a_row",
    "sessionize_gap",
    "consecutive_date_ranges",
    "nth_highest",
    "longest_repeat_free_run",
    "run_length",
    "char_histogram",
    "anagram_groups",
    "rfm_variety",
    "recommend_topk",
    "fx_convert",
    "embedding_topk",
    "html_text",
    "stream_sessions",
]


def run(spark, name: str, sf_dir: str) -> float:
    began = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if wanted == "all" else [n for n in wanted.split(",") if n] or HEADLINE
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(cores=cpus, partitions=int(cpus) if cpus.isdigit() else 8)
    took = {}
    for name in names:
        run(spark, name, sf_dir)
        took[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(runs)), 3)
        print(f"{name}: {took[name]}", file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(took.values()), 3),
                "unit": "sec",
                "queries": took,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
