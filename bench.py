"""Time the headline queries: prints one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS`` (default 8),
``BENCH_RUNS`` timed runs per query after one warm run (default 3, the median
counts), ``BENCH_QUERIES`` comma-separated names. Every run builds the query anew,
staging included, and computes all its rows and columns.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from orcaspark.plans import registry  # noqa: E402
from orcaspark.session import with_settings  # noqa: E402

HEADLINE = (
    "executed_monthly supplier_month cc_flatten reconcile reconcile_strict enrich_planned"
    " enrich_committed consolidate upsert analysis_base kpi trend treemap idle_budget_report"
    " unplanned sunburst inertia_worst top_suppliers committed_correlation suggest_corrections"
    " unit_json"
).split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    spark = with_settings(builder, **{"spark.sql.shuffle.partitions": cpus}).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()
    seconds = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    line = {"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": seconds}
    print(json.dumps({**line, "sf": sf_dir.rstrip("/").split("sf")[-1]}))


if __name__ == "__main__":
    main()
