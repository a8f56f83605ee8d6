"""Runs the registered queries at BENCH_SF_DIR on local[BENCH_CPUS] and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fieldglean import queries as registry  # noqa: E402
from fieldglean.session import get_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "1"))
    only = [n for n in os.environ.get("BENCH_ONLY", "").split(",") if n]
    registry.load_all()
    spark = get_session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
                        spark__driver__memory=os.environ.get("BENCH_MEMORY", "16g"))
    spark.sparkContext.setLogLevel("ERROR")
    # One pass over a table and one Python worker start, so the first query pays for neither.
    registry.QUERIES["html_presence"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in only or sorted(registry.QUERIES):
        times = []
        for _ in range(repeat):
            start = time.perf_counter()
            registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(sorted(times)[len(times) // 2], 3)
    spark.stop()
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
