"""Registered queries of the retail load on the test tables, with their SQL.

They run ``build_star`` itself (promotion fan-out, header and line lookups,
sentinel promotion, calendar from the data), the orphan report, the source
audits, the load counts and the type-2 merge.  The SQL states the same rules
on whole cents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import olap as O
from ..operators import quality as Q
from ..operators.scd2 import scd2_merge
from ..sources.retail_tpch import campaign_id, campaigns, discounts, retail_from_tpch
from ..sources.tpch import read_tpch
from .catalogue import edge
from .etl import build_star, sentinel_promotion

MEASURES = ["lines", "trx", "qty", "revenue", "profit", "cost", "discount"]


def load_by_campaign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures by campaign and year: an order with k campaigns counts every line k times."""
    star = build_star(spark, retail_from_tpch(spark, sf_dir))
    return edge(O.aggregate(star, ["campaign_id", "year"], MEASURES))


def load_by_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures by attributes of the store, payment, customer and supplier looked up by the load."""
    star = build_star(spark, retail_from_tpch(spark, sf_dir))
    return edge(O.aggregate(star, ["region", "payment_type", "membership_level", "supplier_category"], MEASURES))


def load_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Success lines that the load drops, by reason and value."""
    src = retail_from_tpch(spark, sf_dir)
    found = Q.fact_orphans(src, build_star(spark, src).dims)
    return found.groupBy("reason", "value").agg(F.count(F.lit(1)).alias("n_lines"))


def load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q12: rows of every loaded table."""
    out = None
    for name, df in sorted(build_star(spark, retail_from_tpch(spark, sf_dir)).tables().items()):
        one = df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("loaded"), "n_rows")
        out = one if out is None else out.unionByName(one)
    return out


def source_audits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every audit of the raw tables (Q1, Q3-Q7 and Q10): violating rows by audit."""
    found = Q.source_audits(retail_from_tpch(spark, sf_dir))
    out = None
    for name, rows in found.items():
        one = rows.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("audit"), "violations")
        out = one if out is None else out.unionByName(one)
    return out


def promotion_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The campaign table as of three load dates, merged into the
    promotion dimension.  The name carries the number of orders so far, so the
    second load changes campaigns and the third changes none."""
    src = read_tpch(spark, sf_dir)
    used = discounts(src).join(src["orders"].select(
        F.col("o_orderkey").alias("transaction_id"), F.to_date("o_orderdate").alias("day")), "transaction_id")
    tracked = ["campaign_name", "campaign_type", "channel", "target_segment"]

    def snapshot(day: str) -> DataFrame:
        seen = used.where(F.col("day") < F.lit(day).cast("date"))
        n = seen.groupBy(campaign_id(F.col("pct")).alias("campaign_id")).agg(F.count(F.lit(1)).alias("n"))
        named = F.concat_ws(" ", "campaign_name", F.col("n").cast("string"))
        return campaigns(seen).join(n, "campaign_id").withColumn("campaign_name", named).select("campaign_id", *tracked)

    dim = sentinel_promotion(spark)
    dim = dim.select(F.xxhash64("campaign_id", "effective_date").alias("promotion_key"), *dim.columns)
    for day in ("1998-01-01", "2002-01-01", "2002-01-02"):
        # the sentinel is not in the campaign table: it stays as it is
        dim = scd2_merge(dim, snapshot(day), "campaign_id", tracked, day)
    return dim.drop("promotion_key")


LOADS = {f.__name__: f for f in (load_by_campaign, load_by_place, load_orphans, load_counts, source_audits,
                                 promotion_history)}

RAW = """
WITH lines AS (
  SELECT l_orderkey, l_partkey, CAST(l_quantity AS INTEGER) AS quantity,
         CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS detail_id,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS ext, CAST(round(l_discount * 100) AS BIGINT) AS pct
  FROM lineitem
), priced AS (
  SELECT *, ext // quantity AS unit, ((ext // quantity) * pct) // 100 AS off, ext - (ext * pct) // 100 AS sub
  FROM lines
), header AS (
  SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS d, o_orderstatus,
         CAST(round(o_totalprice * 100) AS BIGINT) AS total,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'Cash' WHEN '2-HIGH' THEN 'Debit Card'
              WHEN '3-MEDIUM' THEN 'Credit Card' WHEN '5-LOW' THEN 'E-Wallet' ELSE o_orderpriority END AS method,
         (SELECT min(l_suppkey) FROM lineitem x WHERE x.l_orderkey = o_orderkey) AS store
  FROM orders
), used AS (
  SELECT DISTINCT l_orderkey, pct FROM lines WHERE pct > 0
), fanned AS (
  SELECT p.*, h.*, coalesce('CAM' || lpad(CAST(u.pct AS VARCHAR), 3, '0'), 'NO_PROMO') AS campaign_id
  FROM priced p JOIN header h ON p.l_orderkey = h.o_orderkey
  LEFT JOIN used u ON u.l_orderkey = p.l_orderkey
  WHERE h.o_orderstatus = 'F'
), product AS (
  SELECT p_partkey, CAST(round(p_retailprice * 100) AS BIGINT) AS cost,
         (SELECT min(l_suppkey) FROM lineitem x WHERE x.l_partkey = p_partkey) AS source
  FROM part
), place AS (
  SELECT s_suppkey, r_name FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey
), fact AS (
  SELECT f.*, f.sub - p.cost * f.quantity AS profit, p.cost * f.quantity AS cost_all, st.r_name,
         c.c_mktsegment, p.source,
         CASE f.method WHEN 'Cash' THEN 'cash' WHEN 'E-Wallet' THEN 'digital' ELSE 'card' END AS payment_type
  FROM fanned f JOIN product p ON f.l_partkey = p.p_partkey
  JOIN customer c ON f.o_custkey = c.c_custkey
  JOIN place st ON f.store = st.s_suppkey
  JOIN supplier su ON p.source = su.s_suppkey
  WHERE f.method IN ('Cash', 'Debit Card', 'Credit Card', 'E-Wallet', 'Bank Transfer') AND f.d IS NOT NULL
)
"""

_SUMS = """CAST(count(*) AS BIGINT) AS lines, CAST(count(DISTINCT l_orderkey) AS BIGINT) AS trx,
  CAST(sum(quantity) AS BIGINT) AS qty, CAST(sum(sub) AS DOUBLE) / 100 AS revenue, CAST(sum(profit) AS DOUBLE) / 100 AS profit,
  CAST(sum(cost_all) AS DOUBLE) / 100 AS cost, CAST(sum(off * quantity) AS DOUBLE) / 100 AS discount"""

LOAD_SQL = {
    "load_by_campaign": RAW + f"SELECT campaign_id, CAST(year(d) AS INTEGER) AS year, {_SUMS} FROM fact GROUP BY 1, 2",
    "load_by_place": RAW + f"""SELECT r_name AS region, payment_type, c_mktsegment AS membership_level,
  ['ECONOMY','LARGE','MEDIUM','PROMO','SMALL','STANDARD'][CAST(source % 6 AS INTEGER) + 1] AS supplier_category, {_SUMS}
FROM fact GROUP BY ALL""",
    "load_orphans": RAW + """
SELECT 'unknown payment method' AS reason, method AS value, CAST(count(*) AS BIGINT) AS n_lines FROM fanned
WHERE method NOT IN ('Cash', 'Debit Card', 'Credit Card', 'E-Wallet', 'Bank Transfer') GROUP BY 2
UNION ALL SELECT 'unknown customer', CAST(o_custkey AS VARCHAR), count(*) FROM fanned
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer) GROUP BY 2
UNION ALL SELECT 'unknown product', CAST(l_partkey AS VARCHAR), count(*) FROM fanned
WHERE l_partkey NOT IN (SELECT p_partkey FROM part) GROUP BY 2
UNION ALL SELECT 'unknown store', CAST(store AS VARCHAR), count(*) FROM fanned
WHERE store NOT IN (SELECT s_suppkey FROM supplier) GROUP BY 2
UNION ALL SELECT 'unknown supplier', CAST(source AS VARCHAR), count(*) FROM fanned JOIN product ON l_partkey = p_partkey
WHERE source NOT IN (SELECT s_suppkey FROM supplier) GROUP BY 2""",
    "load_counts": RAW + """
SELECT 'dim_time' AS loaded, CAST(date_diff('day', min(d), max(d)) + 1 AS BIGINT) AS n_rows FROM header WHERE o_orderstatus = 'F'
UNION ALL SELECT 'dim_product', count(*) FROM part UNION ALL SELECT 'dim_customer', count(*) FROM customer
UNION ALL SELECT 'dim_store', count(*) FROM supplier UNION ALL SELECT 'dim_supplier', count(*) FROM supplier
UNION ALL SELECT 'dim_promotion', count(DISTINCT pct) + 1 FROM used
UNION ALL SELECT 'dim_payment_method', 5 UNION ALL SELECT 'fact_sales', count(*) FROM fact""",
    "source_audits": RAW + """
SELECT 'Q1:sales_transaction_details' AS audit, CAST(count(*) AS BIGINT) AS violations
FROM (SELECT detail_id FROM lines GROUP BY 1 HAVING count(*) > 1) x
UNION ALL SELECT 'Q3:sales_transaction_details.transaction_id', count(*) FROM lines
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
UNION ALL SELECT 'Q4:customers.membership_level', count(*) FROM customer
WHERE c_mktsegment NOT IN ('Regular', 'Silver', 'Gold', 'Platinum')
UNION ALL SELECT 'Q4:sales_transactions.payment_method', count(*) FROM header
WHERE method NOT IN ('Cash', 'Debit Card', 'Credit Card', 'E-Wallet', 'Bank Transfer')
UNION ALL SELECT 'Q6', count(*) FROM priced WHERE sub <> (unit - off) * quantity
UNION ALL SELECT 'Q7', count(*) FROM header LEFT JOIN (
  SELECT l_orderkey, sum(unit * quantity) AS t, sum(off * quantity) AS o, sum(sub) AS s FROM priced GROUP BY 1) y
  ON o_orderkey = y.l_orderkey WHERE total <> coalesce(t, 0) OR coalesce(o, 0) <> 0 OR total <> coalesce(s, 0)
UNION ALL SELECT 'Q10', count(*) FROM used LEFT JOIN orders ON l_orderkey = o_orderkey
WHERE o_orderstatus IS NULL OR o_orderstatus <> 'F'
UNION ALL SELECT 'Q1:customers', count(*) FROM (SELECT c_custkey FROM customer GROUP BY ALL HAVING count(*) > 1) x
UNION ALL SELECT 'Q1:stores', count(*) FROM (SELECT s_suppkey FROM supplier GROUP BY ALL HAVING count(*) > 1) x
UNION ALL SELECT 'Q1:suppliers', count(*) FROM (SELECT s_suppkey FROM supplier GROUP BY ALL HAVING count(*) > 1) x
UNION ALL SELECT 'Q1:products', count(*) FROM (SELECT p_partkey FROM part GROUP BY ALL HAVING count(*) > 1) x
UNION ALL SELECT 'Q1:sales_transactions', count(*) FROM (SELECT o_orderkey FROM orders GROUP BY ALL HAVING count(*) > 1) x
UNION ALL SELECT 'Q1:marketing_campaigns', count(*) FROM (SELECT pct FROM (SELECT DISTINCT pct FROM used) d GROUP BY ALL HAVING count(*) > 1) x
UNION ALL SELECT 'Q1:promotion_usage', count(*) FROM (SELECT l_orderkey, pct FROM used LEFT JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL HAVING count(*) > 1) x
UNION ALL SELECT 'Q3:sales_transactions.store_id', count(*) FROM header WHERE store IS NOT NULL AND NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = store)
UNION ALL SELECT 'Q3:sales_transactions.customer_id', count(*) FROM orders WHERE o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey)
UNION ALL SELECT 'Q3:products.supplier_id', count(*) FROM product WHERE source IS NOT NULL AND NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = source)
UNION ALL SELECT 'Q3:promotion_usage.campaign_id', count(*) FROM used WHERE pct NOT IN (SELECT CAST(round(l_discount * 100) AS BIGINT) FROM lineitem WHERE l_discount IS NOT NULL)
UNION ALL SELECT 'Q4:customers.gender', count(*) FROM customer WHERE CASE WHEN c_custkey % 2 = 0 THEN 'Male' ELSE 'Female' END NOT IN ('Male', 'Female')
UNION ALL SELECT 'Q4:stores.store_type', count(*) FROM supplier WHERE CASE WHEN s_suppkey % 2 = 0 THEN 'Mall Store' ELSE 'Standalone Store' END NOT IN ('Mall Store', 'Standalone Store')
UNION ALL SELECT 'Q4:sales_transactions.transaction_status', count(*) FROM orders WHERE o_orderstatus NOT IN ('F', 'O', 'P', 'Success', 'Cancelled', 'Returned')
UNION ALL SELECT 'Q4:suppliers.supplier_status', count(*) FROM supplier WHERE 'Active' NOT IN ('Active', 'Inactive')
UNION ALL SELECT 'Q4:products.product_status', count(*) FROM part WHERE 'Active' NOT IN ('Active', 'Discontinued')
UNION ALL SELECT 'Q4:marketing_campaigns.campaign_type', count(*) FROM (SELECT DISTINCT pct FROM used) d
WHERE ['Discount','Bundle','Cashback','Loyalty'][CAST((pct - 1) % 4 AS INTEGER) + 1] NOT IN ('Discount', 'Bundle', 'Cashback', 'Loyalty')
UNION ALL SELECT 'Q4:marketing_campaigns.channel', count(*) FROM (SELECT DISTINCT pct FROM used) d
WHERE ['Store','Instagram','Website','Email'][CAST((pct - 1) % 4 AS INTEGER) + 1] NOT IN ('Store', 'Instagram', 'Website', 'Email')
UNION ALL SELECT 'Q5:stores.city->province', count(*) FROM (SELECT n_name || '_' || CAST(s_suppkey % 3 AS VARCHAR) AS city FROM supplier
LEFT JOIN nation ON s_nationkey = n_nationkey GROUP BY 1 HAVING count(DISTINCT n_name) > 1) x
UNION ALL SELECT 'Q5:stores.province->region', count(*) FROM (SELECT n_name FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey GROUP BY 1 HAVING count(DISTINCT r_name) > 1) x""",
    "promotion_history": RAW + """
, seen AS (
  SELECT pct, count(*) FILTER (WHERE d < DATE '1998-01-01') AS a, count(*) FILTER (WHERE d < DATE '2002-01-01') AS b
  FROM used JOIN header ON l_orderkey = o_orderkey GROUP BY pct
), version AS (
  SELECT pct, a AS n, DATE '1998-01-01' AS f, CASE WHEN a = b THEN DATE '2099-12-31' ELSE DATE '2001-12-31' END AS t, a = b AS cur
  FROM seen WHERE a > 0
  UNION ALL SELECT pct, b, DATE '2002-01-01', DATE '2099-12-31', TRUE FROM seen WHERE b > 0 AND a <> b
)
SELECT 'CAM' || lpad(CAST(pct AS VARCHAR), 3, '0') AS campaign_id,
  'Campaign ' || CAST(pct AS VARCHAR) || ' ' || CAST(n AS VARCHAR) AS campaign_name,
  ['Discount','Bundle','Cashback','Loyalty'][CAST((pct - 1) % 4 AS INTEGER) + 1] AS campaign_type,
  ['Store','Instagram','Website','Email'][CAST((pct - 1) % 4 AS INTEGER) + 1] AS channel, 'All' AS target_segment,
  f AS effective_date, t AS expiry_date, cur AS is_current FROM version
UNION ALL SELECT 'NO_PROMO', 'No Promotion', 'none', 'none', 'All', DATE '2000-01-01', DATE '2099-12-31', TRUE""",
}
