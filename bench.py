"""Time every headline query on one table directory and print one JSON line.

Settings: BENCH_SF_DIR (tables), BENCH_CPUS (local cores), BENCH_QUERIES (comma list, default all registered queries).
"""

from __future__ import annotations

import json
import os
import sys
import time

from textkg.plans import load_all
from textkg.session import build_session


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    queries = load_all().QUERIES
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else list(queries)
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    # start-up and first code generation are not part of any query
    spark.read.parquet(f"{sf_dir}/nation.parquet").groupBy("n_regionkey").count().collect()
    seconds: dict[str, float] = {}
    failed: dict[str, str] = {}
    for name in names:
        start = time.perf_counter()
        try:
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
        except Exception as ex:  # a failed query must not hide the others
            failed[name] = f"{type(ex).__name__}: {str(ex)[:200]}"
        print(f"{name} {seconds.get(name, failed.get(name))}", file=sys.stderr, flush=True)
        spark.catalog.clearCache()
    line = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
    }
    if failed:
        line["failed"] = failed
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
