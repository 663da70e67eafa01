"""Shuffles of the load: what a plan moves when no table is small."""

import re
from contextlib import contextmanager

import pytest

import __spark_entry__ as E
from starweave.plans import incremental, two_loads
from starweave.plans.etl import build_star
from starweave.plans.two_loads import counted_campaigns
from starweave.session import fine_parts
from starweave.sources.retail_tpch import discounted, discounts, retail_from_tpch
from starweave.sources.tpch import read_tpch

FINE = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.initialPartitionNum")


@contextmanager
def no_small_tables(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    was = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("policy", ["fanout", "allocate", "first"])
def test_fanned_out_lines_are_not_shuffled(spark, retail, policy):
    """The campaigns are the header's; lines meet them once, by transaction."""
    with no_small_tables(spark):
        p = _plan(build_star(spark, retail, promo_policy=policy).fact)
    assert not re.search(r"hashpartitioning\(campaign_id#\d+, trunc", p)     # by campaign and month
    top = next(line for line in p.split("\n") if "Exchange" in line or "Join" in line)
    assert "SortMergeJoin [transaction_id" in top, top


def test_digests_move_hashes_of_lines(spark, retail):
    with no_small_tables(spark):
        lines = _plan(incremental.transaction_digests(retail)).split("\n")
    moved = [lines[i + 1] for i, line in enumerate(lines) if "Exchange hashpartitioning(" in line]
    assert sum("AS __line" in line for line in moved) == 1
    assert not any("subtotal" in line.split("AS __line")[-1] for line in moved)
    # lines are those of known transactions before they look up their products
    at = [i for i, line in enumerate(lines) if "Exchange hashpartitioning(product_id" in line]
    assert any("LeftSemi" in lines[i + 1] for i in at)


def test_campaigns_are_counted_in_one_pass(spark):
    rows = [(1, 0.04), (1, 0.04), (1, 0.07), (2, 0.04), (3, 0.0), (4, None), (9, 0.04)]
    src = {"lineitem": spark.createDataFrame(rows, "l_orderkey long, l_discount double"),
           "orders": spark.createDataFrame([(1, "1999-01-01"), (2, "2001-01-01"), (3, "2001-01-01"), (4, None)],
                                           "o_orderkey long, o_orderdate string")}
    got = counted_campaigns(src)
    assert sorted((r.campaign_id, r.campaign_name) for r in got.collect()) == [("CAM004", "Campaign 4 2"), ("CAM007", "Campaign 7 1")]
    early = counted_campaigns(src, "2000-01-01")
    assert sorted(r.campaign_name for r in early.collect()) == ["Campaign 4 1", "Campaign 7 1"]
    assert sorted(map(tuple, discounts(src).collect())) == sorted(set(map(tuple, discounted(src).collect())))
    with no_small_tables(spark):
        p = _plan(counted_campaigns(src))
    assert p.count("Join") == 1      # orders; the names need none


def test_first_load_follows_from_written_tables(spark, tmp_path, monkeypatch):
    """Repeated, undated and unknown orders count as in the tables as given,
    and lines are grouped by order once for both loads."""
    for t in ("region", "nation", "customer", "supplier", "part"):
        spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet").limit(5).write.parquet(f"{tmp_path}/{t}.parquet")
    orders = [(1, "1999-01-01", "F"), (1, "1999-01-01", "F"), (2, "2001-01-01", "P"), (3, None, "F"), (4, "1999-05-01", "O"), (None, "1999-05-01", "F")]
    spark.createDataFrame([(k, 1, s, 10.0, d, "1-URGENT") for k, d, s in orders],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate string, "
                          "o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    lines = [(1, 0.04, "1999-02-01"), (1, 0.07, "2000-02-01"), (2, 0.04, None), (3, 0.04, "1999-02-01"), (4, 0.0, "1999-06-01"),
             (9, 0.07, "1999-02-01"), (None, 0.04, "1999-02-01")]
    spark.createDataFrame([(k, 1, 1, i, 1.0, 10.0, p, d) for i, (k, p, d) in enumerate(lines)],
                          "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                          "l_extendedprice double, l_discount double, l_shipdate string").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(1).write.parquet(f"{tmp_path}/events.parquet")
    then, now = two_loads.raw_tables(spark, str(tmp_path))
    src = read_tpch(spark, str(tmp_path))
    for got, day in ((now, None), (then, two_loads.CHANGE)):
        want = counted_campaigns(src, day)
        assert got["marketing_campaigns"].columns == want.columns
        assert sorted(map(str, got["marketing_campaigns"].collect())) == sorted(map(str, want.collect()))
    as_given = retail_from_tpch(spark, str(tmp_path))
    for name in ("sales_transactions", "promotion_usage"):
        assert now[name].columns == then[name].columns == as_given[name].columns
        assert sorted(map(str, now[name].collect())) == sorted(map(str, as_given[name].collect()))
    status = sorted(((r.transaction_id or 0), r.transaction_status) for r in then["sales_transactions"].collect())
    assert status == [(0, "Pending"), (1, "Pending"), (1, "Pending"), (4, "Cancelled")]
    dated = retail_from_tpch(spark, str(tmp_path), dated=True)
    with no_small_tables(spark):
        for df in two_loads.as_of_day(dated | {t: spark.createDataFrame([], dated[t].schema) for t in ("sales_transactions", "promotion_usage")},
                                      two_loads.CHANGE).values():
            assert "Join" not in _plan(df)


def test_loads_run_in_fine_parts(spark, monkeypatch):
    """The shuffles of the jobs of a load are cut by rows and joined to few MB."""
    seen = {}

    def look(*_):
        seen.update({k: spark.conf.get(k, None) for k in FINE})
        raise InterruptedError

    was = {k: spark.conf.get(k, None) for k in FINE}
    monkeypatch.setattr(two_loads, "_DONE", {})
    monkeypatch.setattr(two_loads, "raw_tables", look)
    with pytest.raises(InterruptedError):
        two_loads.two_loads(spark, "/root/testdata/sf0.001")
    assert seen[FINE[0]] == str(16 << 20) and int(seen[FINE[1]]) >= 1
    assert was == {k: spark.conf.get(k, None) for k in FINE}
    with fine_parts(spark, 216_000_000):
        assert spark.conf.get(FINE[1]) == "864"
    assert was == {k: spark.conf.get(k, None) for k in FINE}
    monkeypatch.setattr(E, "materialize", look)
    monkeypatch.setattr(E, "_STARS", {})
    seen.clear()
    with pytest.raises(InterruptedError):
        E.star_for(spark, "/root/testdata/sf0.001")
    assert seen[FINE[0]] == str(16 << 20)
