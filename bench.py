"""Benchmark the headline queries.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 3).  Each query is run once to warm up, then
BENCH_REPEAT times; the median wall time (definition + full execution into
a no-op sink) is reported.  ``render_lines`` times the rendering of the line
folder, which the warm-up of the queries hides; it is no part of the total.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from acctlens.plans.queries import QUERIES  # noqa: E402
from acctlens.session import build_session  # noqa: E402
from acctlens.sources.events import events_to_lines, read_events  # noqa: E402

HEADLINE = [
    "parse_cdr", "alive_count", "stop_cause_count", "second_order_stats", "alive_anomalies",
    "cause_mix", "sigma_outliers", "kmeans_outliers", "replay_publish", "stream_second_order",
]


def run_once(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def render_lines(spark, sf_dir: str) -> float:
    t0 = time.perf_counter()
    events_to_lines(read_events(spark, sf_dir)).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus))
    names = sys.argv[1:] or HEADLINE
    timings = {}
    for name in names:
        run_once(spark, name, sf_dir)
        timings[name] = round(statistics.median(run_once(spark, name, sf_dir) for _ in range(repeat)), 3)
    rendered = round(statistics.median(render_lines(spark, sf_dir) for _ in range(repeat)), 3)
    host = {"cores": os.cpu_count(), "load": [round(x, 1) for x in os.getloadavg()]}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_median_total", "value": round(sum(timings.values()), 3), "unit": "sec",
                      "queries": timings, "sf": float(m.group(1)) if m else sf_dir, "cpus": int(cpus),
                      "render_lines": rendered, "host": host}))


if __name__ == "__main__":
    main()
