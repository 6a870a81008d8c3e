"""Benchmark the registered queries; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (timed runs per query after one warm-up, default 3), BENCH_ONLY
(comma-separated subset of query names).
Each query is executed in full through the ``noop`` sink (no collect);
streaming queries run to completion inside their call. The value per query
is the median wall time; ``value`` is the sum of the medians.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from logwise.plans.catalog import QUERIES  # noqa: E402
from logwise.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        f"local[{cpus}]",
        app_name="logwise-bench",
        shuffle_partitions=cpus,
        extra={
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run_once(fn) -> float:
        t0 = time.perf_counter()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    only = [q for q in os.environ.get("BENCH_ONLY", "").split(",") if q]
    selected = {k: v for k, v in QUERIES.items() if not only or k in only}
    for fn in selected.values():  # warm-up: JIT, file listing caches
        run_once(fn)
    timings: dict[str, list[float]] = {name: [] for name in selected}
    for _ in range(runs):
        for name, fn in selected.items():
            timings[name].append(run_once(fn))
    medians = {name: round(statistics.median(ts), 3) for name, ts in timings.items()}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "sum of median query wall time",
                "value": round(sum(medians.values()), 3),
                "unit": "sec",
                "queries": medians,
                "sf": float(m.group(1)) if m else sf_dir,
                "cpus": cpus,
                "runs": runs,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
