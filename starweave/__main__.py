"""Command line: the daily load and catalogue queries.

  python -m starweave load  <sources_root> [--format parquet|csv] [--out PATH] [--promo-policy fanout]
                            [--publish DATABASE]
  python -m starweave query <star_path> <name> [<name> ...] [--limit 20] [--params retail|testdata]
  python -m starweave list
"""

from __future__ import annotations

import argparse
import json
import sys

from .plans.catalogue import CATALOGUE, RETAIL, TESTDATA, TITLES


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="starweave")
    sub = ap.add_subparsers(dest="cmd", required=True)
    ld = sub.add_parser("load", help="build the star and its summaries from the raw retail tables")
    ld.add_argument("sources")
    ld.add_argument("--format", default="parquet")
    ld.add_argument("--out", default=None)
    ld.add_argument("--promo-policy", default="fanout", choices=("fanout", "allocate", "first"))
    ld.add_argument("--publish", default=None, help="catalog database for the summary tables")
    q = sub.add_parser("query", help="run catalogue queries on a written star")
    q.add_argument("star")
    q.add_argument("names", nargs="+")
    q.add_argument("--limit", type=int, default=20)
    q.add_argument("--params", default="retail", choices=("retail", "testdata"),
                   help="literal values: the reference's (retail) or the test tables' equivalents")
    sub.add_parser("list", help="list the catalogue queries")
    a = ap.parse_args(argv)

    if a.cmd == "list":
        print("\n".join(f"{n:28s} {TITLES.get(n, '')}" for n in CATALOGUE))
        return 0

    from pyspark.sql import SparkSession
    spark = SparkSession.builder.appName("starweave").getOrCreate()
    if a.cmd == "load":
        from .plans.etl import load_warehouse
        from .sources.readers import read_sources
        star, statuses, counts = load_warehouse(spark, read_sources(spark, a.sources, a.format), a.out,
                                                promo_policy=a.promo_policy, publish=a.publish)
        print(json.dumps({"star": star.location, "counts": counts,
                          "summaries": {s.name: s.ok for s in statuses}}))
        return 0 if all(s.ok for s in statuses) else 1
    from .plans.materialize import read_star
    star = read_star(spark, a.star)
    for n in a.names:
        print(f"== {n}")
        CATALOGUE[n](star, TESTDATA if a.params == "testdata" else RETAIL).show(a.limit, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
