"""Time the registered queries: ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose the data and the cores.

Every query is run to the end through the ``noop`` sink, so no column is pruned and nothing is
collected. Prints one JSON line. Arguments, if any, are the names of the queries to run.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tidemark.catalog.queries import REGISTRY
from tidemark.session import PARTITIONS_KEY, local_session


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session("bench", cores, cores)
    spark.conf.set(PARTITIONS_KEY, cores)  # the tables here are single small files
    # One small query first, so that no query is charged for starting the JVM.
    run(spark, "year_minmax", sf_dir)
    seconds = {name: run(spark, name, sf_dir) for name in sys.argv[1:] or REGISTRY}
    spark.stop()
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )


if __name__ == "__main__":
    main()
