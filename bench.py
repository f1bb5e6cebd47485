"""Wall time of every query, written to a sink that keeps nothing. Prints one JSON line.

Each query runs once to warm up, then three times; the median counts. Queries that take longer
than LONG when warm run once. BENCH_SF_DIR and BENCH_CPUS choose tables and cores; names on the
command line choose queries.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from sitegauge.plans.queries import QUERIES
from sitegauge.session import build_session
from sitegauge.sources.workdir import clear


LONG = 2.0


def once(name: str, spark: SparkSession, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    chosen = sys.argv[1:] or list(QUERIES)
    seconds = {}
    for name in chosen:
        once(name, spark, sf_dir)
        first = once(name, spark, sf_dir)
        more = [once(name, spark, sf_dir) for _ in range(2)] if first < LONG else []
        seconds[name] = round(statistics.median([first, *more]), 3)
        clear(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total wall time of all queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
