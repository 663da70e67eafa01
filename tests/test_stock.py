"""The stock chain against a walk from movement to movement."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from starweave.operators import quality as Q
from starweave.operators.stock import running_stock

SCHEMA = "id long, store long, product long, hour long, stock_in long, stock_out long, ending_stock string"


def walk(rows, opening=0):
    chains, out = defaultdict(lambda: opening), {}
    for i, s, p, h, a, b, _ in sorted(rows, key=lambda r: (r[3], r[0])):
        before = chains[s, p]
        chains[s, p] = max(0, before + (a or 0) - (b or 0))
        out[i] = (before, chains[s, p])
    return out


def moved(n, seed):
    r = random.Random(seed)
    return [(i, r.choice([1, 1, 1, 2, None]), r.choice([7, 7, 8]), i // 9, r.choice([0, 5, 30, None]), r.choice([0, 4, 35, None]), "x")
            for i in range(n)]


@pytest.mark.parametrize("opening", [0, 40])
def test_chain_equals_a_walk(spark, opening):
    rows = moved(600, 4)
    got = running_stock(spark.createDataFrame(rows, SCHEMA).repartition(5), ["store", "product"], "hour", ["id"], opening)
    assert got.columns == SCHEMA.replace(" long", "").replace(" string", "").split(", ")[:-1] + ["beginning_stock", "ending_stock"]
    out = {r["id"]: (r["beginning_stock"], r["ending_stock"]) for r in got.collect()}
    want = walk(rows, opening)
    assert out == want and sum(end == 0 for _, end in want.values()) > 20


def test_one_long_stretch_and_many_short_ones_agree(spark):
    rows = moved(300, 9)
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"all": F.lit(1), "own": F.col("id")})
    a, b = ({(r["id"], r["ending_stock"]) for r in running_stock(df, ["store", "product"], s, ["id"]).collect()} for s in ("all", "own"))
    assert a == b and len(a) == 300


def test_empty_table_and_bad_opening(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert running_stock(none, ["store"], "hour", ["id"]).count() == 0
    with pytest.raises(ValueError):
        running_stock(none, ["store"], "hour", ["id"], -1)


def test_a_carried_stock_passes_its_audit(spark):
    got = running_stock(spark.createDataFrame(moved(400, 2), SCHEMA).fillna(0, ["stock_in", "stock_out"]), ["store", "product"], "hour", ["id"])
    got = got.withColumn("stock_status", Q.stock_band(F.col("ending_stock")))
    assert Q.stock_violations(got).count() == 0
    wrong = got.withColumn("ending_stock", F.when(F.col("id") == 3, F.col("ending_stock") + 50).otherwise(F.col("ending_stock")))
    assert [r["id"] for r in Q.stock_violations(wrong).collect()] == [3]


def test_a_hot_chain_is_dealt_over_its_stretches(spark):
    df = spark.createDataFrame(moved(20, 1), SCHEMA)
    plan = running_stock(df, ["store", "product"], "hour", ["id"])._jdf.queryExecution().executedPlan().toString()
    rows = [line for line in plan.splitlines() if "Exchange hashpartitioning(store" in line]
    assert rows and any("hour" in line for line in rows)
