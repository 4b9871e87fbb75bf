"""Wall time of the headline queries. Prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8) and
BENCH_QUERIES (comma-separated names, or ``all``) choose what runs.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from logloom.plans import registry  # noqa: E402
from logloom.session import local_session  # noqa: E402

HEADLINE = [
    "error_bursts", "filter_bool_tree", "filter_field_rules", "filter_lines", "recent_events", "order_by_field",
    "top_values", "first_seen", "context_both", "group_avg_max", "group_two_keys", "top_groups", "histogram",
    "series_by_group", "usage_rollup", "trend_levels", "field_profile", "column_ranking", "expanded_rows",
    "suggest_fields", "mask_lines", "template_counts", "template_clusters", "spans_normalized", "services",
    "attributes", "trace_bounds", "batch_roots", "sampled_spans", "waterfall", "shape", "resolve_refs",
    "lint_monitors", "ingest_normalized", "ingest_batches", "jsonl_lines", "tail_dedup", "live_window_counts",
]


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(registry.QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = local_session(cpus, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    run(spark, "group_two_keys", sf_dir)  # start-up cost is not a query
    timings = {}
    for name in names:
        timings[name] = round(run(spark, name, sf_dir), 3)
        if os.environ.get("BENCH_VERBOSE"):
            print(name, timings[name], file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_wall_time",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
