"""Times the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from partload import plans  # noqa: E402
from partload.session import local_session  # noqa: E402

HEADLINE = (
    "scoped_scan",
    "format_roundtrip",
    "schema_resolve",
    "cast_canonical",
    "delimited_roundtrip",
    "dirty_row_gate",
    "plan_units",
    "partitioned_load",
    "multi_source_load",
    "skewed_fanout_load",
    "text_load",
    "idempotent_rerun",
    "register_partitions",
    "rows_per_unit_cap",
    "reconcile_total",
    "reconcile_scoped",
    "resume_pending",
    "run_jobs",
    "audit_append",
    "latest_unit_state",
    "retention_apply",
    "risk_rows",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 1))
    spark = local_session("bench", cpus=cpus)
    queries = plans.queries()
    # Start the JVM and compile the common paths outside the timings.
    queries["partition_parallel_read"](spark, sf_dir).collect()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
