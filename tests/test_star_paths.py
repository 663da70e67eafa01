"""The two physical strategies of Star.base give the same answers."""

from dataclasses import replace

import pytest

from starweave.operators import olap as O
from starweave.plans.catalogue import CATALOGUE, TESTDATA

NAMES = sorted(CATALOGUE)


@pytest.mark.parametrize("name", NAMES)
def test_preagg_equals_broadcast(name, tpch_star):
    b = replace(tpch_star, join_mode="broadcast")
    p = replace(tpch_star, join_mode="preagg")
    rb = sorted(map(tuple, CATALOGUE[name](b, TESTDATA).collect()), key=str)
    rp = sorted(map(tuple, CATALOGUE[name](p, TESTDATA).collect()), key=str)
    assert rb == rp


def test_lazy_star_without_bounds_uses_preagg(spark):
    from starweave.sources.tpch import star_from_tpch
    lazy = star_from_tpch(spark, "/root/testdata/sf0.001")
    assert not lazy.broadcastable("product") and lazy.broadcastable("time")
    plan = CATALOGUE["top_products"](lazy, TESTDATA)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in plan


def header_star(spark, tpch_star):
    """Customers too large to broadcast, everything else small."""
    return replace(tpch_star, bounds={**tpch_star.bounds, "customer": None})


@pytest.mark.parametrize("name", NAMES)
def test_counts_by_customer_equal_broadcast(name, spark, tpch_star):
    p = header_star(spark, tpch_star)
    rb = sorted(map(tuple, CATALOGUE[name](tpch_star, TESTDATA).collect()), key=str)
    rp = sorted(map(tuple, CATALOGUE[name](p, TESTDATA).collect()), key=str)
    assert rb == rp


@pytest.mark.parametrize("mode, sets", [("rollup", None), ("cube", None), ("sets", [["category"], ["membership_level", "quarter"], []])])
def test_grouping_sets_over_lines_and_header(spark, tpch_star, mode, sets):
    keys, measures = ["category", "membership_level", "quarter"], ["trx", "revenue", "lines", "first_date"]
    got = [sorted(map(tuple, O.grouped(s, keys, measures, mode, sets).select(
        *keys, *measures, *[f"g_{k}" for k in keys]).collect()), key=str) for s in (tpch_star, header_star(spark, tpch_star))]
    assert got[0] == got[1] and got[0]


def test_no_transaction_meets_a_large_header_dimension(spark, tpch_star):
    """The transaction is in no exchange after the fact was counted by customer."""
    star = header_star(spark, tpch_star)
    for df in (O.aggregate(star, ["membership_level", "category"], ["trx", "revenue"]),
               O.grouped(star, ["category", "membership_level"], ["trx", "revenue"], "cube"),
               O.grouped(star, ["membership_level", "quarter"], ["trx", "revenue"], "rollup")):
        plan = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
        join = next(i for i, line in enumerate(plan) if "Join Inner" in line and "customer_key" in line and "broadcast" not in line)
        assert all("transaction_id" not in line for line in plan[:join + 1])
