"""Time the catalogue: one warm-up run per query, then the median of three.

Whole builds write and read back many tables, so they run once after their
warm-up. Prints one JSON line; each query's result is consumed in full by a
``noop`` write. ``calibration`` is the median time of a computation that reads
nothing, before and after the queries: rounds on machines of other speeds
compare by it.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from starwright.queries import REGISTRY  # noqa: E402

HEADLINE = [
    "scan_filter_project",
    "songs_dim_distinct",
    "users_dim_latest_all",
    "users_dim_latest_filtered",
    "users_dim_upsert",
    "artists_dim_ranked",
    "artists_dim_do_nothing",
    "time_dim_weekday_one_based",
    "time_dim_weekday_zero_based",
    "surrogate_key_large",
    "keyed_last_write_wins",
    "epoch_ms_to_timestamp",
    "python_literal_unquote",
    "ambience_priority_label",
    "csv_list_counts",
    "stage_truncate_columns",
    "fact_inner_match",
    "fact_left_match",
    "fact_lookup_first_match",
    "fact_md5_key",
    "fact_numeric18_match",
    "fact_interval_slice",
    "reviews_fact",
    "lake_users",
    "lake_songplays",
    "warehouse_songplays",
    "upsert_songplays",
    "roundtrip_json_stage",
    "roundtrip_csv_free_text",
    "partitioned_write_pruned_read",
    "upsert_update_two_batches",
    "repeatable_interval_load",
]
BUILDS = [
    "lake_star_files",
    "warehouse_star_tables",
    "interval_star_time",
    "lookup_tables_from_csv",
    "review_warehouse",
]
# Timed as well, but not part of the total that rounds compare.
OTHERS = ["upsert_ignore_two_batches", "upsert_star_users", "interval_star_facts", "serial_blocks", "sort_key_range"]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("starwright-bench")
        .config("spark.driver.memory", "20g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def seconds(name: str) -> float:
        started = time.perf_counter()
        REGISTRY[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    def calibration() -> float:
        times = []
        for _ in range(4):
            started = time.perf_counter()
            hashes = spark.range(0, 200_000_000, 1, int(cpus)).select(F.xxhash64("id").alias("h"))
            hashes.agg(F.max("h")).collect()
            times.append(time.perf_counter() - started)
        return round(statistics.median(times[1:]), 3)

    before = calibration()
    timings = {}
    for names, runs in ((HEADLINE, 3), (BUILDS, 1)):
        for name in names:
            seconds(name)
            timings[name] = round(statistics.median(seconds(name) for _ in range(runs)), 3)
    others = {}
    for name in OTHERS:
        seconds(name)
        others[name] = round(seconds(name), 3)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries and builds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "others": others,
                "calibration": [before, calibration()],
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": int(cpus),
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
