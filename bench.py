"""Bench: headline catalog jobs on the driver's tables; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (timed runs per job after one warm-up, default 3).
Each job runs to completion through the no-op sink (no driver collect);
the reported time per job is the median of the timed runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "q_etl_tracks",
    "q_top10_per_gen",
    "q_gen_platform",
    "q_gen_artist",
    "q_gen_platform_pivot",
    "q_reject_malformed",
    "q_genre_share_gen",
    "q_genre_share_pivot",
    "q_genre_share_year_pivot",
    "q_top30_slice",
    "q_slice_year_counts",
    "q_top_n_one_gen",
    "q_distinct_artists",
    "q_audit_counts",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    from pyspark.sql import SparkSession

    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("trendloom-bench")
             .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "4g"))
             .config("spark.sql.shuffle.partitions", str(max(2 * cpus, 8)))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from trendloom.plans.catalog_jobs import JOBS

    times = {}
    for name in HEADLINE:
        job = JOBS[name]
        job(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
        samples = []
        for _ in range(runs):
            t0 = time.perf_counter()
            job(spark, sf_dir).write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_median", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus, "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
