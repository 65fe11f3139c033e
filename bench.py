"""Benchmark: run every query of the reference's analytics over ``$BENCH_SF_DIR`` on
``local[$BENCH_CPUS]`` and print one JSON line.

Each query is executed in full through the ``noop`` sink (the whole plan runs,
nothing is collected to the driver). One warm-up pass over all queries, then
``$BENCH_REPEATS`` timed runs per query; the reported time is the median.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillroll.plans.registry import QUERIES  # noqa: E402
from tillroll.session import build_session  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    conf = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")}
    if os.environ.get("BENCH_EVENT_LOG_DIR"):  # stage/task times for later reading
        conf["spark.eventLog.enabled"] = "true"
        conf["spark.eventLog.dir"] = os.environ["BENCH_EVENT_LOG_DIR"]
    spark = build_session(
        f"local[{cpus}]",
        app_name="tillroll-bench",
        shuffle_partitions=int(cpus) * 2,
        conf=conf,
    )
    qs = {k: v for k, v in QUERIES.items() if not only or k in only}
    for fn in qs.values():  # warm-up: JIT, file listing, codegen caches
        run(fn(spark, sf_dir))
    timings: dict[str, float] = {}
    for name, fn in qs.items():
        samples = []
        for _ in range(repeats):
            t0 = time.perf_counter()
            run(fn(spark, sf_dir))
            samples.append(time.perf_counter() - t0)
        timings[name] = round(statistics.median(samples), 3)
    spark.stop()
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": int(cpus),
        "repeats": repeats,
    }))


if __name__ == "__main__":
    main()
