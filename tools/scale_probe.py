"""Scale probe: replicate the fact-side tables N times (order keys shifted,
dimensions unchanged) into a scratch folder, then time the star build and
every catalogue query once warm.  A measurement aid, not a registered query.

Usage: python tools/scale_probe.py <sf_dir> <factor> <scratch_dir>"""

import json
import os
import sys
import time

sys.path.insert(0, ".")

from pyspark.sql import functions as F

from starweave.plans.catalogue import CATALOGUE, TESTDATA
from starweave.plans.materialize import materialize
from starweave.session import local_session
from starweave.sources.tpch import TABLES, star_from_tpch


def main():
    src, factor, out = sys.argv[1], int(sys.argv[2]), sys.argv[3]
    spark = local_session()
    step = spark.read.parquet(f"{src}/orders.parquet").agg(F.max("o_orderkey")).first()[0] + 1
    for t in TABLES:
        if os.path.exists(os.path.join(out, f"{t}.parquet")):
            continue  # reuse a copy made by an earlier run
        df = spark.read.parquet(f"{src}/{t}.parquet")
        if t in ("orders", "lineitem"):
            k = "o_orderkey" if t == "orders" else "l_orderkey"
            df = (df.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(factor - 1))))
                    .withColumn(k, F.col(k) + F.col("copy") * step).drop("copy"))
        df.write.mode("overwrite").parquet(os.path.join(out, f"{t}.parquet"))
    t0 = time.perf_counter()
    star = materialize(star_from_tpch(spark, out), spark)
    build = time.perf_counter() - t0
    for q in CATALOGUE.values():          # warm-up: compile once
        q(star, TESTDATA).collect()
    times = {}
    for name, q in CATALOGUE.items():
        t = time.perf_counter()
        q(star, TESTDATA).collect()
        times[name] = round(time.perf_counter() - t, 3)
    print(json.dumps({"factor": factor, "fact_rows": star.fact.count(), "star_build_sec": round(build, 2),
                      "catalogue_sec": round(sum(times.values()), 2),
                      "slowest": sorted(times.items(), key=lambda x: -x[1])[:5]}))


if __name__ == "__main__":
    main()
