"""Grouping sets with distinct transactions: one shuffle of the lines."""

import re
from dataclasses import replace

import pytest

from starweave.operators import olap as O
from starweave.plans.catalogue import CATALOGUE, TESTDATA


@pytest.mark.parametrize("name", ["cube_cat_region_q", "gsets_single"])
@pytest.mark.parametrize("rows", [1_000_000, 10])
def test_sets_are_expanded_after_the_transactions(name, rows, spark, tpch_star):
    star = replace(tpch_star, broadcast_rows=rows)
    was = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = CATALOGUE[name](star, TESTDATA)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", was)
    above, below = p.split("Expand", 1)
    assert "transaction_id" not in above                      # no set carries transactions
    moved = [m for m in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", below) if "transaction_id" in m]
    assert len(moved) == 1 and moved[0].startswith("transaction_id#") and moved[0].count("#") == 1


@pytest.mark.parametrize("rows", [1_000_000, 10])
def test_marks_count_transactions_of_every_set(spark, tpch_star, rows):
    """Nulls in an attribute, an unknown transaction and one in two groups."""
    star = replace(tpch_star, broadcast_rows=rows)
    fact = star.fact.limit(300).selectExpr("* except (transaction_id)", "CASE WHEN quantity_sold % 7 > 0 THEN transaction_id % 9 END AS transaction_id")
    path = O.PART_LINES
    fact = spark.createDataFrame(fact.collect(), fact.schema)
    products = star.dims["product"].selectExpr("* except (category)", "nullif(category, 'MEDIUM') AS category")
    star = replace(star, fact=fact, dims=star.dims | {"product": products})
    try:
        O.PART_LINES = 100
        got = O.grouped(star, ["category", "region", "quarter"], ["trx", "lines"], "cube").collect()
    finally:
        O.PART_LINES = path
    line = [r.asDict() for r in star.base(["category", "region", "quarter"], ["trx", "lines"]).collect()]
    assert len(line) == 300
    want = {}
    for r in line:
        for mask in range(8):
            key = tuple((g, None if g else r[k]) for k, g in zip(("category", "region", "quarter"), ((mask >> i) & 1 for i in range(3))))
            want.setdefault(key, [set(), 0])
            want[key][1] += 1
            if r["transaction_id"] is not None:
                want[key][0].add(r["transaction_id"])
    assert len(got) == len(want)
    for r in got:
        key = tuple((r[f"g_{k}"], r[k]) for k in ("category", "region", "quarter"))
        assert (r.trx, r.lines) == (len(want[key][0]), want[key][1]), key
