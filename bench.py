"""Time the headline queries: prints one JSON line.

BENCH_SF_DIR names the data (default /root/testdata/sf0.1), BENCH_CPUS the local
threads. Every query runs once to warm up and then BENCH_RUNS times (default 3);
its time is the median. All result columns are computed and thrown away.
"""

import json
import os
import statistics
import tempfile
import time

from pyspark.sql import SparkSession

from wiretide.workload.queries import QUERIES

HEADLINE = (
    "packet_features",
    "full_features",
    "avg_flow_time",
    "active_flow_timeline",
    "flow_summary",
    "packet_direction",
    "stratified_split",
    "classification_report",
    "train_and_score",
    "full_features_cut",
    "direction_by_table_join",
    "features_stream",
)


# The forest is timed with the settings of its baseline, and trained anew each time.
SETTINGS = {"train_and_score": {"n_estimators": 20, "max_depth": 10}}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("wiretide-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="wiretide-"))
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir, **SETTINGS.get(name, {})).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
            spark.catalog.clearCache()
        seconds[name] = round(statistics.median(times[1:]), 3)
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
