"""Time the headline queries; prints one JSON line.

Folder and cores come from BENCH_SF_DIR and BENCH_CPUS.  Each query runs in
full into a sink that discards its rows.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from gramloom.registry import QUERIES

HEADLINE = (
    "tokenize_docs",
    "ngram_counts",
    "best_target",
    "eval_metrics",
    "predict_next",
    "score_positions",
    "clean_chain",
    "clean_funnel",
    "compare_n",
    "compare_n_conversations",
    "final_model",
    "extract_methods",
    "exact_split_docs",
)


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", "20g")
        .config("spark.sql.shuffle.partitions", str(2 * int(cpus)) if cpus.isdigit() else "16")
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "128MB")
        # The tables are small and the work on them is bound by CPU: partitions of 64 KB still keep all cores busy.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64KB")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]}s", file=sys.stderr, flush=True)
    scale = os.path.basename(sf_dir).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )


if __name__ == "__main__":
    main()
