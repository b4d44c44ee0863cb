"""Time the registered queries; prints one JSON line.

BENCH_SF_DIR is the folder of tables, BENCH_CPUS the number of local cores, and
BENCH_QUERIES an optional comma list of query names.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from gableboard.plans import catalogue  # noqa: E402


def session(cpus: str) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # The local files are small; smaller splits give every core a task.
        .config("spark.sql.files.maxPartitionBytes", "2m")
        .config("spark.sql.files.openCostInBytes", "256k")
        # Joins shuffle from 256 KB on, so that the work after them uses every core.
        .config("spark.sql.autoBroadcastJoinThreshold", "256k")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    wanted = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    # Start-up cost is not a query's.
    spark.read.parquet(f"{folder}/nation.parquet").count()
    timings = {}
    for name, query in catalogue.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.perf_counter()
        query(spark, folder).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {timings[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(timings.values()), 3), "unit": "sec",
        "queries": timings, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
