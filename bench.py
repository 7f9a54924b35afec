"""Wall time of every query at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Each query runs once to warm up and then ``$BENCH_RUNS`` times; the median
counts. Results go to the ``noop`` sink, so every row and column is computed.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from pathlib import Path

from pyspark.sql import SparkSession

import snapfeed as sf
from checks.queries import QUERIES
from snapfeed.scratch import scratch_dir

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
NAMES = [name for name in os.environ.get("BENCH_QUERIES", "").split(",") if name]


def once(spark: SparkSession, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def run_cost(spark: SparkSession) -> dict[str, float]:
    """One run over everything against one over the last hundredth of the snapshots.

    The index is derived from ``lineitem``, one snapshot per ship date and eight
    entries per row, in eight periods one after another. It is an ``IndexTable``;
    writing it is not timed.
    """
    path = scratch_dir(spark, "bench-index")
    index = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").selectExpr(
        "*", "explode(sequence(0, 7)) as period"
    ).selectExpr(
        "(l_orderkey * 8 + l_linenumber) * 8 + period as lin",
        "concat_ws('/', '/ifs/data', l_returnflag, period, l_orderkey, l_linenumber) as path",
        "'regular' as file_type",
        "cast(datediff(l_shipdate, date '1990-01-01') + 5000 * period as bigint) as s2",
        "array('ENTRY_ADDED') as change_types",
    )
    sf.IndexTable(spark, path).append(index, partitions=64)
    stored = sf.IndexTable(spark, path).read()
    first, last = stored.selectExpr("min(s2)", "max(s2)").first()
    log = sf.CheckpointLog(spark, scratch_dir(spark, "bench-log"))
    scope = sf.FolderScope("/ifs/data")
    log.commit("last", scope.kind, scope.key, 1, last - (last - first) // 100)
    log.commit("none", scope.kind, scope.key, 1, first - 1)

    def run(app: str) -> float:
        start = time.perf_counter()
        changes = sf.IncrementalRun(sf.IndexTable(spark, path), log, scope, app=app)
        changes.changes().write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    times = {"none": [], "last": []}
    for _ in range(RUNS + 3):
        for app, taken in times.items():
            taken.append(run(app))
    seconds = {app: statistics.median(taken[3:]) for app, taken in times.items()}
    return {
        "entries": stored.count(),
        "full_run": round(seconds["none"], 4),
        "incremental_run": round(seconds["last"], 4),
        "incremental_to_full": round(seconds["last"] / seconds["none"], 3),
    }


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in NAMES or QUERIES:
        once(spark, name)
        seconds[name] = round(statistics.median(once(spark, name) for _ in range(RUNS)), 4)

    files = spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(Path(SF_DIR).name.removeprefix("sf") or 0),
        "cpus": int(CPUS),
        "index_rows": files,
        "index_rows_per_sec": {n: round(files / s) for n, s in seconds.items() if s},
    }
    if not NAMES:
        result["run_cost"] = run_cost(spark)
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
