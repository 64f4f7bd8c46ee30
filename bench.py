"""Times headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Each query writes to the no-op sink, so that every result column is computed. The value is the
sum over queries of the median of the warm runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from tideline.plans.queries import REGISTRY

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
QUERIES = [
    "materialize_table",
    "materialize_onto_base",
    "decode_records",
    "flatten_image",
    "encode_roundtrip",
    "read_after_checkpoint",
    "limit_per_shard",
    "limit_per_shard_clamped",
    "limit_per_shard_large",
    "decode_stored",
    "read_stored_after_sequence",
    "replay_order",
    "progress_checkpoints",
    "unprocessed_counts",
    "throughput_by_shard",
    "classify_api_errors_skip",
    "extend_closed_leaves",
    "plan_new_progress_latest",
    "sync_progress",
    "stream_materialize",
    "stream_stateful_latest",
]


def main() -> None:
    scratch = tempfile.mkdtemp(prefix="tideline-bench-")
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("tideline-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.checkpoint.dir", f"{scratch}/checkpoint")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    seconds = {}
    for name in sys.argv[1:] or QUERIES:
        times = []
        for _ in range(RUNS + 1):
            begin = time.perf_counter()
            REGISTRY[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - begin)
        seconds[name] = round(statistics.median(times[1:]), 3)
    result = {
        "metric": "sum of median warm query times",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
