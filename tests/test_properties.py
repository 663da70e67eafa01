"""Property-style invariants on random retail loads."""

import datetime as dt
from dataclasses import replace
from decimal import Decimal as D

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from starweave.operators import history as H
from starweave.plans.catalogue import CATALOGUE, RETAIL
from starweave.plans.etl import build_star
from starweave.sources.schemas import SOURCE_SCHEMAS
from tests.retail_fixture import retail_sources

PRICES = {"P1": (D("15.00"), D("10.00")), "P2": (D("30.00"), D("20.00")), "P3": (D("8.00"), D("5.00"))}
METHODS = ["Cash", "Debit Card", "Credit Card", "E-Wallet", "Bank Transfer"]

line = st.tuples(st.sampled_from(sorted(PRICES)), st.integers(1, 4), st.sampled_from([D("0.00"), D("1.00")]))
trx = st.tuples(st.integers(0, 364), st.sampled_from(["S1", "S2", "S3", "S4"]),
                st.sampled_from(["C1", "C2", "C3", "C4", "C5", "C6", "C7"]), st.sampled_from(METHODS),
                st.lists(line, min_size=1, max_size=3), st.sets(st.sampled_from(["CAM001", "CAM002"]), max_size=2))


def _sources(spark, base, txs):
    t_rows, d_rows, u_rows = [], [], []
    for i, (day, store, cust, method, lines, camps) in enumerate(txs):
        tid, date = f"T{i}", dt.date(2025, 1, 1) + dt.timedelta(days=day)
        tot = disc = 0
        for j, (pid, qty, dpi) in enumerate(lines):
            price = PRICES[pid][0]
            d_rows.append((f"D{i}_{j}", tid, pid, qty, price, dpi, (price - dpi) * qty))
            tot += price * qty
            disc += dpi * qty
        t_rows.append((tid, date, store, cust, "E1", method, tot, disc, tot - disc, "Success"))
        u_rows += [(f"U{i}{c}", c, tid, cust, "X", D("1.00"), date) for c in sorted(camps)]
    src = dict(base)
    for name, rows in (("sales_transactions", t_rows), ("sales_transaction_details", d_rows),
                       ("promotion_usage", u_rows)):
        src[name] = spark.createDataFrame(rows, SOURCE_SCHEMAS[name])
    return src


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(st.lists(trx, min_size=1, max_size=12))
def test_invariants(spark, txs):
    base = retail_sources(spark, clean=True)
    star = build_star(spark, _sources(spark, base, txs))
    total = star.table("fact_sales").agg(F.sum("final_sales")).first()[0] or D(0)

    g = [r for r in CATALOGUE["rollup_geo3"](star, RETAIL).collect() if r.region == ">> GRAND TOTAL"]
    assert float(total) == g[0].total_revenue

    for r in CATALOGUE["pivot_cat_quarter"](star, RETAIL).collect():
        assert abs(r.Q1 + r.Q2 + r.Q3 + r.Q4 - r.Total) < 1e-6

    ytd = CATALOGUE["ytd_revenue"](star, RETAIL).orderBy(F.desc("month")).first()
    assert abs(ytd.ytd_revenue - float(total)) < 1e-6

    if total > 0:
        s = CATALOGUE["payment_share"](star, RETAIL).agg(F.sum("pct_share")).first()[0]
        assert abs(s - 100) <= 0.01 * 5

    ranked = CATALOGUE["store_rank_month"](star, RETAIL)
    w = Window.partitionBy("year", "month").orderBy(F.desc("revenue"))
    assert ranked.withColumn("r2", F.rank().over(w)).filter("monthly_rank != r2").count() == 0

    for name in ("cube_member_payment", "mom_growth", "category_contribution"):
        a = sorted(map(tuple, CATALOGUE[name](replace(star, join_mode="broadcast"), RETAIL).collect()), key=str)
        b = sorted(map(tuple, CATALOGUE[name](replace(star, join_mode="preagg"), RETAIL).collect()), key=str)
        assert a == b, name
