"""Time every registered query once and print one JSON line.

Reads ``BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[BENCH_CPUS]``. ``BENCH_ONLY`` takes a
comma-separated list of query names.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from doseledger.plans.catalogue import QUERIES
from doseledger.session import build_session


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count() or 4)
    only = [n for n in os.environ.get("BENCH_ONLY", "").split(",") if n]
    spark = build_session(
        "doseledger-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="doseledger-bench-"),
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # start the executors and the code cache before the first measured query
    QUERIES["drug_summary"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    for name in only or QUERIES:
        start = time.perf_counter()
        try:
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
        except Exception as error:
            print(f"{name}: {type(error).__name__}: {str(error)[:300]}", file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
