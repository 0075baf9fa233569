"""Time every registered query at $BENCH_SF_DIR; prints one JSON line.

Each query is built and run once to warm up the JVM on small data, then timed
once: building the plan, staging included, and evaluating every column.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.queries import REGISTRY  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
WARM_DIR = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
CPUS = os.environ.get("BENCH_CPUS", "8")


def run(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name in REGISTRY:
        run(spark, name, WARM_DIR)
    seconds = {name: run(spark, name, SF_DIR) for name in REGISTRY}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds_all_queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(SF_DIR).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
