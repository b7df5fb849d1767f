"""Time the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (data folder), BENCH_CPUS (local cores), BENCH_RUNS (timed runs
per query, the median counts).

The tables are first copied, untimed, into as many files as there are cores: a landed table
has many, the given files have one row group each, which a single task would read. Every
query then runs once on the smallest tables, so that its code is compiled, before it is
timed; a query that has used BENCH_PATIENCE seconds is not repeated.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import tempfile
import time
from pathlib import Path

from railyard.session import local_session
from workload import QUERIES

HEADLINE = [
    "norm_transborder",
    "norm_carloadings",
    "norm_ocean_rates",
    "norm_waybills",
    "value_by_mode",
    "write_day_partitions",
    "merge_year_partitions",
    "dedup_keep_latest",
    "carloads_by_railroad",
    "top_commodities",
    "carloads_trend",
    "avg_rate_by_route",
    "lane_stats",
    "rate_trend",
    "profile_columns",
    "describe_numeric",
    "asof_release",
    "parse_release_pages",
]
PATIENCE = float(os.environ.get("BENCH_PATIENCE", "12"))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores)
    spark.sparkContext.setLogLevel("OFF")

    def run(name: str, folder: str) -> float:
        began = time.monotonic()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.monotonic() - began

    with tempfile.TemporaryDirectory(prefix="bench-") as copy:
        for file in sorted(Path(sf_dir).glob("*.parquet")):
            if file.stem in ("documents", "embeddings", "labels", "conversations", "benchmark"):
                continue
            spark.read.parquet(str(file)).repartition(int(cores)).write.parquet(f"{copy}/{file.name}")
        small = re.sub(r"sf[0-9.]+$", "sf0.001", sf_dir)
        times = {}
        for name in HEADLINE:
            if Path(small).is_dir():
                run(name, small)
            taken: list[float] = []
            while len(taken) < runs and sum(taken) < PATIENCE:
                taken.append(run(name, copy))
            times[name] = round(statistics.median(taken), 3)
    found = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(found.group(1)) if found else None,
            }
        )
    )


if __name__ == "__main__":
    main()
