"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

The two copies are derived from the driver's tables and stored once, in the
layout the plans are written for; that preparation is timed on its own. Every
query then runs to its last row (the output is discarded, not collected).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

from checks.fixtures import StoredFixtures
from checks.queries import BUILDERS

HEADLINE = (
    "join_missing",
    "join_count_default0",
    "join_phrase",
    "join_key_diff",
    "agg_distinct_by_year",
    "agg_distinct_by_unit_second",
    "agg_histogram_second",
    "win_latest",
    "win_batch",
    "pipe_replay",
    "pipe_source_multiplicity",
    "pipe_key_multiplicity",
    "pipe_year_counts",
    "pipe_reconcile",
    "pipe_reconcile_exact",
    "pipe_source_lookup",
    "pipe_dedup_month",
    "pipe_verify",
    "pipe_migrate",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    scratch = tempfile.mkdtemp(prefix="twinledger-bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("twinledger-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.checkpoint.dir", f"{scratch}/checkpoint")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    start = time.perf_counter()
    fixtures = StoredFixtures(spark, sf_dir, f"{scratch}/copies").store()
    prepare = time.perf_counter() - start
    seconds: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        BUILDERS[name](fixtures).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(Path(sf_dir).name.removeprefix("sf")),
                "prepare_sec": round(prepare, 3),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
