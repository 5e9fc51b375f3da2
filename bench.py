"""Time the registered queries and print one JSON line.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (local cores), BENCH_QUERIES (comma-separated names,
default all). Every query runs once to warm up and once measured; the result goes to a no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from millrace.plans.registry import all_queries  # noqa: E402
from millrace.session import build_session  # noqa: E402


def timed(query, spark, folder) -> float:
    start = time.perf_counter()
    query.run(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n]
    spark = build_session(
        "bench", f"local[{cpus}]",
        spark__ui__enabled="false", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    warm, cold = {}, {}
    for name, query in all_queries().items():
        if wanted and name not in wanted:
            continue
        cold[name] = round(timed(query, spark, folder), 3)
        warm[name] = round(timed(query, spark, folder), 3)
    print(json.dumps({
        "metric": "total_warm_query_time", "value": round(sum(warm.values()), 3), "unit": "sec",
        "queries": warm, "cold": cold, "sf": Path(folder).name.removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
