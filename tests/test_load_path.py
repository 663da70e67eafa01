"""The load's calendar, the single-scan audit and column names shared by fact and dimension."""

import shutil
from dataclasses import replace

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from starweave.operators import olap as O
from starweave.operators import quality as Q
from starweave.plans.catalogue import CATALOGUE, RETAIL
from starweave.plans.etl import build_star
from starweave.plans.load_checks import LOAD_SQL, source_audits
from starweave.sources.retail_tpch import retail_from_tpch


def test_calendar_covers_every_sale(spark, retail):
    star = build_star(spark, retail)
    reasons = {r.reason for r in Q.fact_orphans(retail, star.dims).collect()}
    assert "date outside calendar" not in reasons
    fixed = build_star(spark, retail, "2025-01-01")
    assert fixed.fact.count() < star.fact.count()
    assert "date outside calendar" in {r.reason for r in Q.fact_orphans(retail, fixed.dims).collect()}


def test_audit_counts_equal_the_single_audits(spark, retail):
    star = build_star(spark, retail)
    tables = star.tables()
    tables["dim_product"] = tables["dim_product"].limit(1).unionByName(tables["dim_product"].limit(1))
    got = {r.audit: r.violations for r in Q.star_audit_counts(tables).collect()}
    assert got == {k: v.count() for k, v in Q.star_audits(tables).items()}
    assert got["Q1:dim_product"] == 1 and got["Q3:fact_sales.product_key"] > 0


def test_group_by_a_name_of_fact_and_dimension(spark, retail):
    star = build_star(spark, retail)
    both = [sorted(map(tuple, O.aggregate(replace(star, join_mode=m), ["unit_price"], ["qty"]).collect()))
            for m in ("broadcast", "preagg")]
    assert both[0] == both[1] and both[0]


def test_dense_quarters_and_year_to_date(spark, retail):
    star = build_star(spark, retail, "2025-01-01")
    for name in ("qoq_growth", "ytd_revenue", "ytd_transactions", "seasonality_index"):
        plain, dense = (CATALOGUE[name](star, replace(RETAIL, dense=d)).count() for d in (False, True))
        assert dense >= plain, name
    top = CATALOGUE["top_products"](replace(star, fact=star.fact.withColumn(
        "quantity_sold", F.when(F.col("product_key") == star.fact.first().product_key, None).otherwise(F.col("quantity_sold")))), RETAIL)
    assert top.first().total_sold is None


def test_every_source_audit_is_counted(spark, tmp_path):
    """A repeated customer and order, an order of nobody and a part no one supplies, on the test tables."""
    base = "/root/testdata/sf0.001"
    names = ("customer", "supplier", "nation", "region", "part", "orders", "lineitem")
    for name in names:
        shutil.copyfile(f"{base}/{name}.parquet", tmp_path / f"{name}.parquet")
    customer, orders = pq.read_table(f"{base}/customer.parquet"), pq.read_table(f"{base}/orders.parquet")
    pq.write_table(pa.concat_tables([customer, customer.slice(0, 1)]), tmp_path / "customer.parquet")
    at = orders.schema.get_field_index("o_custkey")
    nobody = orders.slice(1, 1).set_column(at, orders.schema.field(at), pa.array([10 ** 8], orders.schema.field(at).type))
    pq.write_table(pa.concat_tables([orders, orders.slice(0, 1), nobody]), tmp_path / "orders.parquet")
    got = {r.audit: r.violations for r in source_audits(spark, str(tmp_path)).collect()}
    assert set(got) == set(Q.source_audits(retail_from_tpch(spark, str(tmp_path)))) and len(got) == 27
    assert got["Q1:customers"] == 1 and got["Q1:sales_transactions"] == 2 and got["Q3:sales_transactions.customer_id"] == 1
    db = duckdb.connect()
    for name in names:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet'")
    want = dict(db.execute(LOAD_SQL["source_audits"]).fetchall())
    loose = {k for k in want if k in ("Q6", "Q7", "Q10")}    # their lines fan out on repeated orders
    assert {k: v for k, v in got.items() if k not in loose} == {k: v for k, v in want.items() if k not in loose}
    spark.catalog.clearCache()
    clean = {r.audit: r.violations for r in source_audits(spark, base).collect()}
    for name in names:
        db.execute(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM '{base}/{name}.parquet'")
    assert clean == dict(db.execute(LOAD_SQL["source_audits"]).fetchall())
