"""Seconds per query at ``$BENCH_SF_DIR``, as one JSON line.

Every query runs once to warm the code paths up on a small scale where there is one, then
``$BENCH_RUNS`` times at full scale; the median counts. Results are fully computed and thrown away.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from portdelta.catalog import QUERIES
from portdelta.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "1"))
ONLY = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
WARM_DIR = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")


def seconds(run, spark, sf: str) -> float:
    start = time.perf_counter()
    run(spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = build_session(
        "portdelta-bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = ONLY or list(QUERIES)
    warm = os.path.isdir(WARM_DIR) and WARM_DIR != SF_DIR
    times: dict[str, float] = {}
    for name in names:
        if warm:
            seconds(QUERIES[name], spark, WARM_DIR)
        times[name] = round(statistics.median(seconds(QUERIES[name], spark, SF_DIR) for _ in range(RUNS)), 3)
    spark.stop()
    total = round(sum(times.values()), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": total,
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
            }
        )
    )


if __name__ == "__main__":
    main()
