"""Time the named queries: one JSON line on standard output.

BENCH_SF_DIR   folder of the tables      (default /root/testdata/sf0.1)
BENCH_CPUS     local cores               (default 8)
BENCH_RUNS     timed runs per query      (default 3, after one warm-up; the median counts)
BENCH_QUERIES  comma-separated names     (default: the headline queries)

Results go to the no-op sink, so every row is computed and nothing is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from flowaudit import build_session
from flowaudit.plans.catalog import QUERIES

HEADLINE = (
    "delta_by_run", "delta_by_row", "delta_by_row_events", "reconcile_counts",
    "reconcile_one_feed", "running_totals", "op_counts", "batch_buckets", "row_id_in_batch",
    "duplicate_keys", "orphan_rows", "rows_per_run", "run_schedule", "elapsed_seconds",
    "record_lag", "lag_stats", "lag_stats_sampled", "current_lag", "attribute_app",
    "conform_typed", "size_text_to_bytes", "checkpoint_items", "payload_envelope",
    "payload_properties", "property_changes", "emit_on_change", "match_type", "flatten_nested",
    "target_config", "batches_by_count", "batches_by_time", "batch_states", "target_stats",
    "events_per_batch", "last_batch", "phase_breakdown", "parse_logs", "log_level_counts",
    "log_context", "table_app_detail", "table_counters_delta", "table_latency_report",
    "table_column_catalog", "table_warehouse_target_stats", "table_log_events",
    "stream_time_batches", "stream_reconcile",
)


def run_once(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else list(HEADLINE)
    spark = build_session(
        "flowaudit-bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings = {}
    for name in names:
        run_once(spark, name, sf_dir)
        timings[name] = statistics.median(run_once(spark, name, sf_dir) for _ in range(runs))
        print(f"{name} {timings[name]:.3f}", file=sys.stderr)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": {n: round(t, 3) for n, t in timings.items()},
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
