"""Seconds per headline query: one warm-up, then the median of three runs. Prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import time

from tidemark.queries import REGISTRY
from tidemark.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 3

HEADLINE = (
    "full_scan", "delta_scan_date", "sample_scan", "load_plan", "table_inventory",
    "clean_nonfinite", "infer_integral", "narrow_integral", "clean_round", "truncate_strings", "conform_schema",
    "load_ready_counts", "load_ready_rejects", "dedupe_latest",
    "range_plan", "assign_range", "range_counts", "range_load_counts",
    "dq_results", "dq_duplicates", "dq_aggregates", "reconcile_rows", "reconcile_repeated_keys",
    "csv_roundtrip", "full_load", "delta_load", "sync_run", "stream_ingest", "late_catchup",
    "v_latest_runs", "v_daily_summary", "alert_rows",
)
# Rows that the loads move, for rows per second: tables read by each, counted below.
LOADS = {"full_load": ("customer", "customer"), "delta_load": ("orders", "orders"), "csv_roundtrip": ("part",),
         "range_load_counts": ("orders",), "stream_ingest": ("events",),
         "sync_run": ("lineitem", "customer", "nation")}


def main() -> None:
    spark = build_session("tidemark-bench", f"local[{CPUS}]",
                          **{"spark.sql.shuffle.partitions": CPUS, "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        REGISTRY[name].run(spark, SF_DIR).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in HEADLINE:
        run(name)
        seconds[name] = round(statistics.median(run(name) for _ in range(RUNS)), 4)
    rows = {t: spark.read.parquet(f"{SF_DIR}/{t}.parquet").count() for ts in LOADS.values() for t in ts}
    rate = {n: round(sum(rows[t] for t in ts) / seconds[n]) for n, ts in LOADS.items()}
    spark.stop()
    print(json.dumps({
        "metric": "headline queries, total of median seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"), "load_rows_per_sec": rate}))


if __name__ == "__main__":
    main()
