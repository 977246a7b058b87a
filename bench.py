"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) select data and
cores. Every query is computed in full into Spark's ``noop`` sink; the best of
BENCH_RUNS (default 2) runs counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tipoff.workload import QUERIES  # noqa: E402

HEADLINE = (
    "bronze_hash",
    "bronze_upsert",
    "read_latest",
    "payload_to_games",
    "stats_pivot",
    "season_team_stats",
    "game_dimensions",
    "season_record",
    "record_splits",
    "season_to_date",
    "form_last10",
    "streaks",
    "head_to_head",
    "matchups",
    "opponent_strength",
    "prediction_features",
    "quality_rules",
    "lineage_impact",
)


def main(names: list[str]) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tipoff-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names or HEADLINE:
        best = None
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            elapsed = time.perf_counter() - start
            best = elapsed if best is None else min(best, elapsed)
        times[name] = round(best, 3)
    spark.stop()
    total = round(sum(times.values()), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": total,
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main(sys.argv[1:])
