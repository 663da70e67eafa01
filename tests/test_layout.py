"""Catalog-table layout: fact and the largest dimension bucketed alike."""

import uuid
from dataclasses import replace

from starweave.plans.catalogue import CATALOGUE, TESTDATA
from starweave.plans.materialize import read_star_tables, write_star_tables


def test_bucketed_layout_same_results_and_no_exchange(spark, tpch_star):
    db = "sw_" + uuid.uuid4().hex[:8]
    write_star_tables(tpch_star, spark, db, colocate="product", buckets=8)
    star = read_star_tables(spark, db)
    assert star.colocated == "product" and star.bounds["product"] == tpch_star.bounds["product"]
    for name in ("top_products", "rollup_product", "category_margin"):
        a = sorted(map(tuple, CATALOGUE[name](star, TESTDATA).collect()), key=str)
        b = sorted(map(tuple, CATALOGUE[name](tpch_star, TESTDATA).collect()), key=str)
        assert a == b, name
    # product as a large dimension: pre-aggregation and join reuse the buckets
    prev = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        big = replace(star, broadcast_rows=10)
        plan = CATALOGUE["top_products"](big, TESTDATA)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", prev)
    assert "Bucketed: true" in plan
    assert "Exchange hashpartitioning(product_key" not in plan
