"""Time the registered queries and print one JSON line.

Every query runs once to warm up and then BENCH_RUNS times; the median counts. Rows are computed in
full and thrown away. The stored_* entries run on an observation table written once beforehand: the daily
report in one pass and in two passes, and the aggregates joined back to all rows.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from vedrina.operators.extremes import agg_join_back, daily_extremes
from vedrina.plans.checks import QUERIES
from vedrina.plans.observations import observations
from vedrina.schemas import EXTREMES_KEYS
from vedrina.shared import new_path

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
ONLY = os.environ.get("BENCH_ONLY", "").split()
# A local run; on a cluster this is a folder that all executors share.
FOLDER = os.environ.get("BENCH_FOLDER") or tempfile.mkdtemp(prefix="vedrina-bench-")


def session() -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("vedrina-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", FOLDER)
        .config("spark.sql.warehouse.dir", f"{FOLDER}/warehouse")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("OFF")
    return spark


def run(frame: DataFrame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def timed(query) -> float:
    run(query())
    seconds = []
    for _ in range(RUNS):
        start = time.perf_counter()
        run(query())
        seconds.append(time.perf_counter() - start)
    return round(statistics.median(seconds), 3)


def main() -> None:
    spark = session()
    stored_path = new_path(spark, f"bench-{uuid.uuid4().hex}")
    observations(spark, SF_DIR).write.partitionBy("datum").parquet(stored_path)
    stored = spark.read.parquet(stored_path)
    queries = {name: (lambda query=query: query(spark, SF_DIR)) for name, query in QUERIES.items()}
    queries |= {
        "stored_extremes": lambda: daily_extremes(stored, None),
        "stored_extremes_two_pass": lambda: daily_extremes(stored, None, values_path=new_path(spark, "values")),
        "stored_agg_join_back": lambda: agg_join_back(stored, EXTREMES_KEYS, "temperatura", new_path(spark, "values")),
    }
    seconds = {name: timed(query) for name, query in queries.items() if not ONLY or name in ONLY}
    result = {
        "metric": "median seconds per query, summed",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "cpus": int(CPUS),
    }
    print(json.dumps(result), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
