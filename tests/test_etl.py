"""Raw retail tables -> star (FIXTURES.md A cases)."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from starweave.operators import quality as Q
from starweave.plans.etl import build_star, dimensions


def _fact(star):
    return star.table("fact_sales")


@pytest.fixture(scope="module")
def fanout(spark, retail):
    return build_star(spark, retail, "2025-01-01")


def test_status_filter_and_fact_count(fanout):
    f = _fact(fanout)
    trx = {r.transaction_id for r in f.select("transaction_id").distinct().collect()}
    # Cancelled T2 and Returned T3 never reach the fact; T6 (out of calendar)
    # and T7 (unknown product) are dropped by the lookups.
    assert trx == {"T1", "T4", "T5", "T8", "T9"}
    # 2 + 2 lines x 2 campaigns + 1 + 1 + 1
    assert f.count() == 9


def test_no_promo_and_duplicate_usage(spark, fanout):
    f = fanout.table("fact_sales").join(fanout.dims["promotion"], "promotion_key")
    rows = {(r.transaction_id, r.campaign_id): r.n for r in
            f.groupBy("transaction_id", "campaign_id").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert rows[("T1", "NO_PROMO")] == 2
    # CAM001 used twice on T4 counts once (distinct pairs), fan-out over 2 campaigns
    assert rows[("T4", "CAM001")] == 2 and rows[("T4", "CAM002")] == 2


@pytest.mark.parametrize("policy,rows,t4_revenue", [("fanout", 9, D("100.00")), ("allocate", 9, D("50.00")),
                                                    ("first", 7, D("50.00"))])
def test_promo_policies(spark, retail, policy, rows, t4_revenue):
    f = _fact(build_star(spark, retail, "2025-01-01", promo_policy=policy))
    assert f.count() == rows
    t4 = f.filter("transaction_id = 'T4'").agg(F.sum("final_sales").alias("r"), F.sum("quantity_sold").alias("q")).first()
    assert t4.r == t4_revenue
    if policy == "allocate":
        assert t4.q == 4  # 3 + 1 units, split without loss


def test_allocate_keeps_totals(spark, retail):
    a = _fact(build_star(spark, retail, "2025-01-01", promo_policy="allocate"))
    g = a.groupBy("detail_id").agg(F.sum("final_sales").alias("s"), F.sum("cost_amount").alias("c"))
    got = {r.detail_id: (r.s, r.c) for r in g.collect()}
    assert got["D5"] == (D("42.00"), D("30.00"))


def test_repeated_load_is_identical(spark, retail):
    a = _fact(build_star(spark, retail, "2025-01-01")).orderBy("detail_id", "promotion_key").collect()
    b = _fact(build_star(spark, retail, "2025-01-01")).orderBy("detail_id", "promotion_key").collect()
    assert a == b
    promo = build_star(spark, retail, "2025-01-01").dims["promotion"]
    assert promo.filter("campaign_id = 'NO_PROMO'").count() == 1


def test_measures(fanout):
    r = _fact(fanout).filter("detail_id = 'D2'").first()
    assert (r.quantity_sold, r.total_sales, r.discount_amount, r.final_sales, r.cost_amount, r.gross_profit) == \
        (1, D("30.00"), D("5.00"), D("25.00"), D("20.00"), D("5.00"))


def test_age_bands(fanout):
    got = {r.customer_id: r.age_group for r in fanout.dims["customer"].collect()}
    assert [got[c] for c in ["C1", "C2", "C3", "C4", "C5", "C6", "C7"]] == [
        "Youth (< 26)", "Adult (26-39)", "Adult (26-39)", "Middle (40-54)", "Middle (40-54)",
        "Senior (55+)", "Senior (55+)"]


def test_orphan_audit(spark, retail):
    dims = dimensions(spark, retail)
    rep = {(r.detail_id, r.reason) for r in Q.fact_orphans(retail, dims).collect()}
    assert rep == {("D8", "date outside calendar"), ("D9", "unknown product")}


def test_star_audits_clean(fanout):
    for name, df in Q.star_audits(fanout.tables()).items():
        assert df.count() == 0, name


def test_observed_counts_match(spark, retail):
    from starweave.plans.materialize import load_manifest, write_star
    path = write_star(build_star(spark, retail, "2025-01-01"), spark)
    counts = load_manifest(spark, path)
    assert counts["fact_sales"] == 9 and counts["dim_time"] == 730 and counts["dim_promotion"] == 3
    assert counts == Q.load_counts({t: spark.read.parquet(f"{path}/{t}") for t in counts})


def test_dimension_schemas_match_the_star_ddl(spark, retail, tpch_star):
    from starweave.plans.star import DIMENSIONS, FACT_COLUMNS
    from starweave.sources.schemas import STAR_SCHEMAS
    for star in (build_star(spark, retail, "2025-01-01"), tpch_star):
        for dim, (table, _) in DIMENSIONS.items():
            assert tuple(star.dims[dim].columns) == STAR_SCHEMAS[table], table
        assert tuple(star.table("fact_sales").columns) == FACT_COLUMNS


def test_transaction_level_collapse_matches_distinct_plan(spark, retail):
    from dataclasses import replace as _replace
    from starweave.plans.catalogue import CATALOGUE, RETAIL
    star = build_star(spark, retail, "2025-01-01")
    assert "store" in star.trx_level and "promotion" not in star.trx_level
    plain = _replace(star, trx_level=frozenset())
    for name in ("rollup_geo", "rollup_geo3", "cube_member_payment", "rollup_time", "pivot_age_gender",
                 "gsets_single"):
        a = sorted(map(tuple, CATALOGUE[name](star, RETAIL).collect()), key=repr)
        b = sorted(map(tuple, CATALOGUE[name](plain, RETAIL).collect()), key=repr)
        assert a == b, name
    assert "promotion" in build_star(spark, retail, "2025-01-01", promo_policy="first").trx_level
