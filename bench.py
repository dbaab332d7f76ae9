"""Time the headline queries; print one JSON line.

BENCH_SF_DIR   folder of the parquet tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_RUNS     timed runs per query after one warm-up (default 3; median kept)
BENCH_QUERIES  comma-separated names, or "all" (default: the headline queries)
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

from isoloir.checks.queries import QUERIES
from isoloir.session import session_builder

HEADLINE = (
    "flagship",
    "build_2017",
    "metropolitan_layer",
    "composite_key_join",
    "attach_coordinates",
    "decimal_comma",
    "split_coordinates",
    "union_by_name",
    "departments",
    "communes_by_department",
    "quantile_cuts",
    "quantile_class",
    "quantile_class_ties",
    "quantile_class_heavy_tail",
    "stations_in_long_list",
    "stations_in_many_pairs",
    "clustered_roundtrip",
    "linear_size",
    "extent",
    "scaled_points",
    "typed_roundtrip",
    "delimited_roundtrip",
    "ragged_rows",
    "communes_in_chunks",
    "geo_split_scan",
    "headers_of_two_orders",
    "replaced_together",
)


def run(spark, query, sf_dir) -> float:
    """Seconds to build the query and to produce every row of its result."""
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    wanted = os.environ.get("BENCH_QUERIES", "")
    # One machine: its driver and executors share this folder, and it goes afterwards.
    with tempfile.TemporaryDirectory(prefix="bench-") as shared:
        seconds = measure(cpus, shared, sf_dir, runs, wanted)
    scale = re.search(r"sf([\d.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "sum of the queries' median wall-clock seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else sf_dir,
            }
        )
    )


def measure(cpus: str, shared: str, sf_dir: str, runs: int, wanted: str) -> dict[str, float]:
    """The median seconds of each query in one session."""
    names = list(QUERIES) if wanted == "all" else wanted.split(",") if wanted else HEADLINE
    spark = (
        session_builder("bench")
        .master(f"local[{cpus}]")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.checkpoint.dir", shared)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        run(spark, QUERIES[name], sf_dir)
        taken = [run(spark, QUERIES[name], sf_dir) for _ in range(runs)]
        seconds[name] = round(statistics.median(taken), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    spark.stop()
    return seconds


if __name__ == "__main__":
    main()
