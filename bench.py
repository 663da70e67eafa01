"""Benchmark: star build, every catalogue query (cold + median of 3 warm)
and summary reads vs direct queries, on local[$BENCH_CPUS] at $BENCH_SF_DIR.

Prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from starweave.plans.catalogue import CATALOGUE, TESTDATA
from starweave.plans.materialize import materialize
from starweave.plans.summaries import read_summary, refresh_summaries
from starweave.session import local_session
from starweave.sources.tpch import star_from_tpch

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
WARM = int(os.environ.get("BENCH_WARM_RUNS", "3"))


def timed(fn):
    t0 = time.perf_counter()
    fn()
    return time.perf_counter() - t0


def main():
    extra = {"spark.sql.shuffle.partitions": CPUS}
    if os.environ.get("BENCH_EVENT_LOG"):  # stage/task times for later analysis
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG"]})
    spark = local_session(CPUS, app="starweave-bench", **extra)
    spark.range(1).collect()  # JVM and session start-up are not part of the build
    t_build = time.perf_counter()
    star = materialize(star_from_tpch(spark, SF_DIR), spark)
    t_build = time.perf_counter() - t_build

    cold, warm = {}, {}
    for name, q in CATALOGUE.items():
        cold[name] = timed(lambda: q(star, TESTDATA).collect())
        warm[name] = statistics.median(timed(lambda: q(star, TESTDATA).collect()) for _ in range(WARM))

    t_refresh = time.perf_counter()
    statuses = refresh_summaries(star, spark, TESTDATA)
    t_refresh = time.perf_counter() - t_refresh
    summary_read = {}
    for st in statuses:
        if st.ok:
            summary_read[st.name] = statistics.median(
                timed(lambda: read_summary(spark, st).collect()) for _ in range(WARM))

    total = sum(warm.values())
    print(json.dumps({
        "metric": "catalogue_warm_total",
        "value": round(total, 3),
        "unit": "sec",
        "queries": {k: round(v, 4) for k, v in warm.items()},
        "cold": {k: round(v, 4) for k, v in cold.items()},
        "star_build_sec": round(t_build, 3),
        "summary_refresh_sec": round(t_refresh, 3),
        "summary_read_sec": {k: round(v, 4) for k, v in summary_read.items()},
        "summary_direct_sec": {k: round(warm[k], 4) for k in summary_read},
        "fact_rows": star.fact.count(),
        "sf": os.path.basename(SF_DIR.rstrip("/")).replace("sf", ""),
        "cpus": CPUS,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
