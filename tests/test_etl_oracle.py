"""The raw-retail load checked against an independent SQL statement of the
same rules (Success lines, distinct usage pairs, left join to usage,
NO_PROMO, inner lookups, the five measures), run by DuckDB on the fixture."""

import os
import tempfile

import duckdb
from pyspark.sql import functions as F

from starweave.plans.etl import build_star

FACT_SQL = """
WITH trx AS (SELECT * FROM sales_transactions WHERE transaction_status = 'Success'),
promo AS (SELECT DISTINCT transaction_id, campaign_id FROM promotion_usage),
lines AS (
  SELECT d.*, t.transaction_date, t.store_id, t.customer_id, t.payment_method,
         p.cost_price, p.supplier_id, COALESCE(pr.campaign_id, 'NO_PROMO') AS campaign_id
  FROM sales_transaction_details d
  JOIN trx t USING (transaction_id)
  JOIN products p USING (product_id)
  LEFT JOIN promo pr USING (transaction_id))
SELECT l.transaction_id, l.detail_id, l.campaign_id, l.quantity AS quantity_sold,
       CAST(l.unit_price * l.quantity AS DOUBLE) AS total_sales,
       CAST(l.discount_per_item * l.quantity AS DOUBLE) AS discount_amount,
       CAST(l.subtotal AS DOUBLE) AS final_sales,
       CAST(l.cost_price * l.quantity AS DOUBLE) AS cost_amount,
       CAST(l.subtotal - l.cost_price * l.quantity AS DOUBLE) AS gross_profit
FROM lines l
WHERE l.transaction_date BETWEEN DATE '2025-01-01' AND DATE '2026-12-31'
  AND l.customer_id IN (SELECT customer_id FROM customers)
  AND l.store_id IN (SELECT store_id FROM stores)
  AND l.supplier_id IN (SELECT supplier_id FROM suppliers)
  AND l.payment_method IN ('Cash', 'Debit Card', 'Credit Card', 'E-Wallet', 'Bank Transfer')
  AND (l.campaign_id = 'NO_PROMO' OR l.campaign_id IN (SELECT campaign_id FROM marketing_campaigns))
"""


def test_fact_matches_sql(spark, retail):
    root = tempfile.mkdtemp(prefix="sw-etl-oracle-")
    con = duckdb.connect()
    for t, df in retail.items():
        p = os.path.join(root, t)
        df.write.parquet(p)
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}/*.parquet')")
    star = build_star(spark, retail, "2025-01-01")
    f = (star.table("fact_sales").join(star.dims["promotion"], "promotion_key")
         .select("transaction_id", "detail_id", "campaign_id", "quantity_sold",
                 *[F.col(c).cast("double").alias(c) for c in
                   ("total_sales", "discount_amount", "final_sales", "cost_amount", "gross_profit")]))
    got = sorted(tuple(r) for r in f.collect())
    want = sorted(tuple(r) for r in con.sql(FACT_SQL).fetchall())
    assert got == want and len(got) == 9
