"""Time the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma-separated names, default all of HEADLINE), BENCH_RUNS (default 2).
``queries`` has the fastest of the runs, ``first`` the first one, which includes
compiling the generated code.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from tidemark.plans.queries import QUERIES

HEADLINE = (
    "doc_identity", "content_identity", "corpus_totals", "qa_valid", "dedup_last_wins", "diff_counts",
    "diff_ops", "next_state", "applied_changes", "chunk_fixed", "chunk_recursive", "payload_build",
    "encode_hashed", "export_totals", "sync_report",
)


def session(cpus: int) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(HEADLINE)
    spark = session(int(os.environ.get("BENCH_CPUS", "8")))
    # Starts the executors' JVM code paths and Python workers; not timed.
    QUERIES["export_totals"](spark, folder).collect()
    runs = max(1, int(os.environ.get("BENCH_RUNS", "2")))
    seconds: dict[str, float] = {}
    first: dict[str, float] = {}
    for name in names:
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken = round(time.perf_counter() - start, 3)
            first.setdefault(name, taken)
            seconds[name] = min(taken, seconds.get(name, taken))
        print(f"{name}: {seconds[name]} (first {first[name]})", file=sys.stderr)
    spark.stop()
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
        "first": first,
    }))


if __name__ == "__main__":
    main()
