"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data folder and ``BENCH_CPUS`` the local cores. All
queries run once to warm up and are then timed from building the plan to the last
row; results go to Spark's no-op sink, so nothing is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from meterfold import build_session, plans, scratch  # noqa: E402

HEADLINE = (
    "AGG-9_global_recap",
    "AGG-6_distributor_window",
    "AGG-7_concentrator_window",
    "AGG-1_word_count",
    "AGG-5_mean_per_key",
    "AGG-13_zone_breakdown",
    "AGG-17_pivot",
    "AGG-20_vector_mean",
    "JOI-2_parent_readings",
    "JOI-5_dense_grid",
    "JOI-6_nearest_centroid",
    "WIN-2_change",
    "WIN-5_latest_per_key",
    "WIN-7_retention",
    "WIN-12_running_total",
    "WIN-14_balanced_parents",
    "ORD-3_top_n",
    "ORD-4_top_outliers",
    "SCA-8_expected_load",
    "SCA-10_hash_slot",
    "SRC-5_strict_envelopes",
    "STR-2_cascade",
    "KMN-5_fit",
)
ROLL_UP = "AGG-9_global_recap"


def seconds(run) -> float:
    start = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "meterfold-bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
    )
    spark.sparkContext.setLogLevel("FATAL")
    queries = plans.runnables()
    times = {}
    for _ in ("warm up", "timed"):
        for name in HEADLINE:
            run = queries[name]
            times[name] = round(seconds(lambda: run(spark, folder)), 3)
    readings = spark.read.parquet(f"{folder}/events.parquet").count()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "roll_up_readings_per_sec": round(readings / times[ROLL_UP]),
            }
        )
    )
    scratch.clear(spark)
    spark.stop()


if __name__ == "__main__":
    main()
