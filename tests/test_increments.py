"""As-of versions, loads that build what changed, summaries from the difference."""

import datetime as dt
from dataclasses import replace
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from starweave.operators.asof import as_of_join, version_intervals
from starweave.plans import incremental, summary_state
from starweave.plans.catalogue import CATALOGUE, RETAIL
from starweave.plans.etl import build_star, load_warehouse, next_promotions
from starweave.plans.materialize import fact_parts, read_star, write_star
from starweave.plans.summaries import read_summary
from tests.retail_fixture import retail_sources


def day(s):
    return dt.date.fromisoformat(s)


def edit(spark, src, table, change=None, add=(), drop=None):
    """A copy of the sources with rows of ``table`` changed, added or dropped."""
    schema, rows = src[table].schema, [r.asDict() for r in src[table].collect()]
    rows = [r for r in rows if drop is None or not drop(r)]
    for r in rows:
        for k, v in (change(r) or {}).items() if change else ():
            r[k] = v
    return src | {table: spark.createDataFrame([tuple(r[f] for f in schema.names) for r in rows] + list(add), schema)}


def content(star):
    return {t: sorted(map(repr, df.select(*sorted(df.columns)).collect())) for t, df in star.tables().items()}


def summaries(spark, statuses):
    assert all(s.ok for s in statuses), statuses
    out = {}
    for s in statuses:
        df = read_summary(spark, s)
        out[s.name] = sorted(map(repr, df.select(*sorted(df.columns)).collect()))
    return out


# ------------------------------------------------------------------ as-of join
def test_as_of_join_takes_the_version_in_force(spark):
    versions = spark.createDataFrame(
        [("A", day("2025-01-15"), 1), ("A", day("2025-03-01"), 2), ("A", day("2025-03-20"), 3), ("B", day("2030-01-01"), 4),
         ("C", day("2000-01-01"), 5), ("C", day("2024-06-01"), 6)], "c string, effective_date date, v int")
    span = {"first": "2025-01-01", "last": "2025-12-31"}
    days = ["2025-01-01", "2025-01-14", "2025-01-15", "2025-02-28", "2025-03-01", "2025-03-19", "2025-03-20", "2025-12-31"]
    rows = [(k, day(d), i) for k in "ABCX" for i, d in enumerate(days)] * 2 + [(None, day(days[0]), 9), ("A", None, 9)]
    sales = spark.createDataFrame(rows, "c string, sold date, n int")
    got = as_of_join(sales, version_intervals(versions, "c", **span), "c", "sold", ["v"])
    assert got.columns == ["c", "sold", "n", "v"]
    seen = {(r.c, str(r.sold)): r.v for r in got.collect()}
    assert [seen["A", d] for d in days] == [1, 1, 1, 1, 2, 2, 3, 3]
    assert {seen["B", d] for d in days} == {4} and {seen["C", d] for d in days} == {6}
    assert got.count() == 2 * 3 * len(days)
    assert as_of_join(sales, version_intervals(versions, "c", **span), "c", "sold", ["v"], "left").count() == len(rows)


def test_as_of_join_is_an_equi_join_by_month(spark):
    versions = spark.createDataFrame([("A", day("2025-01-15"), 1)], "c string, effective_date date, v int")
    sales = spark.createDataFrame([("A", day("2025-02-01"))], "c string, sold date")
    df = as_of_join(sales, version_intervals(versions, "c", first="2025-01-01", last="2025-03-31"), "c", "sold", ["v"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "__month" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


# ------------------------------------------------------------------ loads
def further(spark, src):
    """The fixture some days later: every kind of change."""
    src = edit(spark, src, "sales_transactions",
               lambda r: {"T2": {"transaction_status": "Success"}, "T1": {"transaction_status": "Returned"},
                          "T5": {"store_id": "S1"}}.get(r["transaction_id"]),
               add=[("T10", day("2026-01-05"), "S1", "C3", "E1", "Cash", D("8.00"), D("0.00"), D("8.00"), "Success"),
                    ("T11", day("2025-07-01"), "S1", "C3", "E1", "Cash", D("30.00"), D("0.00"), D("30.00"), "Success")],
               drop=lambda r: r["transaction_id"] == "T9")
    src = edit(spark, src, "sales_transaction_details", lambda r: {"quantity": 4} if r["detail_id"] == "D10" else None,
               add=[("D20", "T10", "P3", 1, D("8.00"), D("0.00"), D("8.00")), ("D21", "T11", "P2", 1, D("30.00"), D("0.00"), None)])
    src = edit(spark, src, "promotion_usage", add=[("U9", "CAM001", "T11", "C3", "X", D("1.00"), day("2025-07-01"))])
    src = edit(spark, src, "products", lambda r: {"category": "Seating"} if r["product_id"] == "P2" else
               {"supplier_id": "SP2"} if r["product_id"] == "P3" else None)
    src = edit(spark, src, "customers", lambda r: {"membership_level": "Platinum"} if r["customer_id"] == "C6" else None)
    src = edit(spark, src, "stores", lambda r: {"store_name": "Toko Z"} if r["store_id"] == "S4" else None)
    return edit(spark, src, "marketing_campaigns", lambda r: {"channel": "Website"} if r["campaign_id"] == "CAM001" else None,
                add=[("CAM003", "Promo Tiga", "Bundle", day("2025-06-01"), day("2025-12-31"), "Store", D("1.00"), "All")])


@pytest.fixture(scope="module")
def loads(spark, retail):
    """A load, and a further one that builds what changed."""
    first, _, _ = load_warehouse(spark, retail)
    before = content(first)
    star, statuses, counts = load_warehouse(spark, further(spark, retail), previous=first.location, load_date="2025-06-01")
    assert content(read_star(spark, first.location)) == before        # readers of the last load see no change
    return first, star, statuses, counts


def test_increment_equals_a_load_of_everything(spark, retail, loads):
    first, star, statuses, counts = loads
    whole, all_statuses, all_counts = load_warehouse(spark, further(spark, retail), previous=first.location,
                                                     load_date="2025-06-01", incremental=False)
    assert content(star) == content(whole) and counts == all_counts
    assert summaries(spark, statuses) == summaries(spark, all_statuses)
    kinds = {r.transaction_id: r.kind for r in spark.read.parquet(f"{star.location}/_touched").collect()}
    assert kinds == {"T2": "added", "T10": "added", "T11": "added", "T1": "removed", "T9": "removed", "T5": "changed",
                     "T8": "changed", "T6": "dimension", "T4": "changed"}


def test_increment_with_allocated_campaigns(spark, retail):
    first, _, _ = load_warehouse(spark, retail, promo_policy="allocate")
    src, kw = further(spark, retail), dict(promo_policy="allocate", load_date="2025-06-01")
    step = incremental.advance(spark, src, first.location, **kw)
    promotions = next_promotions(first.dims["promotion"], src["marketing_campaigns"], "2025-06-01")
    assert content(step.star) == content(build_star(spark, src, promo_policy="allocate", promotions=promotions))


def test_sales_keep_the_version_of_their_day(loads):
    first, star, _, _ = loads
    promo = star.dims["promotion"].select("promotion_key", "campaign_id", "channel")
    seen = {(r.transaction_id, r.campaign_id): r.channel for r in star.fact.join(promo, "promotion_key").collect()}
    assert seen["T4", "CAM001"] == "Store" and seen["T11", "CAM001"] == "Website"      # sold in February and in July
    old = {r.promotion_key for r in first.fact.where("transaction_id = 'T4'").collect()}
    assert old == {r.promotion_key for r in star.fact.where("transaction_id = 'T4'").collect()}


def test_years_without_change_stay_in_their_folder(spark, retail, loads, monkeypatch):
    one = loads[0]
    later = edit(spark, retail, "sales_transactions", lambda r: {"customer_id": "C2"} if r["transaction_id"] == "T6" else None)
    two, _, _ = load_warehouse(spark, later, previous=one.location, load_date="2025-06-01")
    parts = dict(fact_parts(spark, two.location))
    assert parts == {f"{one.location}/fact_sales": [2025], f"{two.location}/fact_sales": [2024]}
    same, statuses, _ = load_warehouse(spark, later, previous=two.location, load_date="2025-06-02")
    assert dict(fact_parts(spark, same.location)) == parts            # nothing changed: nothing written
    assert spark.read.parquet(f"{same.location}/_touched").count() == 0 and all(s.ok for s in statuses)
    monkeypatch.setattr(incremental, "MAX_PARTS", 2)
    packed, _, _ = load_warehouse(spark, retail, previous=same.location, load_date="2025-06-03")
    assert dict(fact_parts(spark, packed.location)) == {f"{packed.location}/fact_sales": [2024, 2025]}
    assert content(packed)["fact_sales"] == content(one)["fact_sales"]
    plan = same.fact.where("sale_year = 2024")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [") >= 1


def test_a_star_without_digests_cannot_be_advanced(spark, retail, loads):
    path = write_star(build_star(spark, retail), spark)       # a star of another writer
    assert not incremental.can_advance(spark, path, "fanout")
    assert incremental.can_advance(spark, loads[0].location, "fanout")
    assert not incremental.can_advance(spark, loads[0].location, "first")


def test_digests_ignore_order_and_see_every_column(spark, retail):
    def digests(src):
        return {r.transaction_id: (r.digest, r.n) for r in incremental.transaction_digests(src).collect()}

    base = digests(retail)
    assert set(base) == {"T1", "T4", "T5", "T6", "T7", "T8", "T9"}
    assert digests(retail | {"sales_transaction_details": retail["sales_transaction_details"].orderBy(F.rand(3))}) == base
    for table, change in (("sales_transaction_details", {"quantity": None}), ("sales_transaction_details", {"subtotal": D("1.00")}),
                          ("sales_transactions", {"payment_method": None}), ("products", {"cost_price": D("9.00")})):
        key = {"sales_transaction_details": "detail_id", "sales_transactions": "transaction_id", "products": "product_id"}[table]
        row = {"detail_id": "D7", "transaction_id": "T5", "product_id": "P2"}[key]
        got = digests(edit(spark, retail, table, lambda r: change if r[key] == row else None))
        assert got["T5"] != base["T5"] and got["T4"] == base["T4"]


# ------------------------------------------------------------------ summaries
def test_states_give_the_summaries(spark, loads):
    star = loads[0]
    some = star.fact.select("transaction_id").distinct().where("transaction_id <> 'T4'")
    rest = star.fact.select("transaction_id").distinct().where("transaction_id = 'T4'")
    for name, s in summary_state.STATES.items():
        want = sorted(map(repr, (lambda df: df.select(*sorted(df.columns)))(CATALOGUE[name](star, RETAIL)).collect()))
        whole = summary_state.state(star, name)
        parts = [summary_state.state(star, name, RETAIL, ids) for ids in (some, rest)]
        for df in (whole, summary_state.merge(parts[0], parts[0].limit(0), parts[1], s),
                   summary_state.merge(whole, parts[1], parts[1], s)):
            got = summary_state.finish(df, name)
            assert sorted(map(repr, got.select(*sorted(got.columns)).collect())) == want, name
        gone = summary_state.merge(whole, whole, parts[0].limit(0), s)
        assert gone.count() == 0


def test_a_summary_that_fails_does_not_stop_the_others(spark, loads, monkeypatch):
    first, star, _, _ = loads
    names = ("mv_store_performance", "mv_monthly_sales")
    broken = replace(summary_state.STATES[names[0]], finish=lambda df: 1 / 0)
    monkeypatch.setitem(summary_state.STATES, names[0], broken)
    step = incremental.Step(star, first, spark.read.parquet(f"{star.location}/_touched"))
    assert [s.ok for s in summary_state.advance_summaries(step, spark, names=names)] == [False, True]


def test_first_load_of_an_empty_source(spark):
    src = {k: v.limit(0) for k, v in retail_sources(spark, clean=True).items()}
    empty, _, _ = load_warehouse(spark, src)
    star, statuses, _ = load_warehouse(spark, retail_sources(spark, clean=True), previous=empty.location, load_date="2025-06-01")
    assert star.fact.count() == 10 and all(s.ok for s in statuses)
