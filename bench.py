"""Time the registered queries and print one JSON line.

``BENCH_SF_DIR`` is the data folder, ``BENCH_CPUS`` the local core count,
``BENCH_QUERIES`` an optional comma-separated choice of queries. A query is
timed from the call to its last row, with everything it stores on the way.
"""

from __future__ import annotations

import json
import os
import time

from workload.compare import local_session
from workload.queries import QUERIES


def run(spark, name: str, sf_dir: str) -> float:
    start = time.monotonic()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.monotonic() - start


def main() -> None:
    sf_dir = os.getenv("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.getenv("BENCH_CPUS", str(os.cpu_count() or 8))
    chosen = os.getenv("BENCH_QUERIES")
    names = chosen.split(",") if chosen else list(QUERIES)
    spark = local_session(cores)
    run(spark, "clean_products", sf_dir)  # warm-up of the JVM, not counted
    timings = {name: round(run(spark, name, sf_dir), 3) for name in names}
    print(
        json.dumps(
            {
                "metric": "total time of the registered queries",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
