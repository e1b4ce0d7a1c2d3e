"""Time the headline queries over one set of tables and print one JSON line.

Settings come from BENCH_SF_DIR and BENCH_CPUS. Every query runs over its whole input and writes all of
its result to the ``noop`` sink; each time is the better of two runs.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from millrace import catalog
from millrace.session import build_session

HEADLINE = [
    "rate_exact",
    "reconcile",
    "partition_totals",
    "assign_chunk",
    "assign_chunk_per_range",
    "running_total",
    "insert_if_absent",
    "insert_repeated_keys",
    "insert_stored_twice",
    "replace_stored",
    "mark_processed",
    "check_constraints",
    "sign_token",
    "verify_token",
    "checksum",
    "scan_lenient_lines",
    "bundle_manifest",
    "commit_prefix",
    "dead_letter",
    "isolate_partitions",
    "dispatch_payloads",
    "launch_decision",
    "run_audit",
    "rate_per_minute",
    "p95",
    "run_incremental",
    "job_person_etl",
    "job_dispatch_recovery",
    "job_ticket_signing",
    "job_event_bundles",
    "job_harvest",
    "job_billing",
    "job_payment_summary",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    settings = {"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-")}
    spark = build_session("bench", f"local[{cpus}]", **settings)
    spark.sparkContext.setLogLevel("ERROR")
    catalog.QUERIES["id_bounds"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    cold: dict[str, float] = {}
    for name in names:
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name], cold[name] = round(min(runs), 3), round(runs[0], 3)
        print(f"{name} {runs[0]:.2f} {runs[1]:.2f}", file=sys.stderr, flush=True)
    spark.stop()
    scale = os.path.basename(sf_dir).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total time of headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "first_runs": cold,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )


if __name__ == "__main__":
    main()
