"""Benchmark: run the registered queries on $BENCH_SF_DIR with
local[$BENCH_CPUS] and print one JSON line.

Each query runs to completion through the ``noop`` sink (the whole plan
executes, nothing is collected to the driver).  Every timed query does all of
its own work: reports build their intermediates lazily, nothing is shared
between queries.  The whole suite is timed a second time with shared
intermediates (``materialize``) as ``suite_shared_sec``.

Outside the timed part, and reported: a warm-up of the report suite on the
small inputs in $BENCH_WARMUP_DIR (default /root/testdata/sf0.001; set it
empty to skip), which compiles the JVM and the generated stage code, and the
derivation of the report inputs from $BENCH_SF_DIR.  The training-data
queries (if the subpackage is present) are timed once, cold, as
``llm_queries``; they are not part of ``value``.
"""

from __future__ import annotations

import importlib.util
import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from deskpulse.session import build_session  # noqa: E402
from deskpulse.plans.registry import QUERIES  # noqa: E402
from deskpulse.plans.shared import materialize  # noqa: E402
from deskpulse.sources import load_tables  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    extra = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")}
    for kv in filter(None, os.environ.get("BENCH_CONF", "").split(",")):
        k, v = kv.split("=", 1)
        extra[k] = v
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(cpus)))
    spark = build_session(f"local[{cpus}]", app="deskpulse-bench", shuffle_partitions=parts, extra=extra)
    extra_queries = {}
    if getattr(importlib.util.find_spec("deskpulse.llm"), "origin", None):
        from deskpulse.llm.registry import QUERIES as extra_queries
    names = [q for q in only or QUERIES if q in QUERIES]
    more = [q for q in only or extra_queries if q in extra_queries]
    warm = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    t0 = time.perf_counter()
    if warm and os.path.isdir(warm) and os.path.abspath(warm) != os.path.abspath(sf_dir):
        for name in names:
            QUERIES[name](spark, warm).write.format("noop").mode("overwrite").save()
    warmup_sec = time.perf_counter() - t0
    t0 = time.perf_counter()
    load_tables(spark, sf_dir)  # derive and write the report inputs (data preparation, untimed)
    prepare_sec = time.perf_counter() - t0

    def run(registry, listed):
        times = {}
        for name in listed:
            t0 = time.perf_counter()
            registry[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - t0, 3)
        return times

    times = run(QUERIES, names)
    llm_times = run(extra_queries, more)
    materialize(load_tables(spark, sf_dir))
    shared_times = run(QUERIES, names)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "llm_queries": llm_times,
        "suite_shared_sec": round(sum(shared_times.values()), 3),
        "untimed": {"warmup_sec": round(warmup_sec, 3), "prepare_inputs_sec": round(prepare_sec, 3)},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
