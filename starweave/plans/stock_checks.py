"""Registered queries of the stock, rating and feedback rules (Q8, Q9, Q11)
on tables mapped from the events, with their SQL.

The SQL of the stock goes from movement to movement by recursion, one step of
every chain at a time, and knows nothing of prefix sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality as Q
from ..sources.retail_tpch import retail_from_tpch
from ..sources.stock_tpch import customer_feedback, inventory_stock


def stock_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stock before and after every movement, and as recorded."""
    return inventory_stock(spark, sf_dir)


def audit_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q8: records whose stock or status does not follow from their movement."""
    return Q.stock_violations(inventory_stock(spark, sf_dir)).select(
        "stock_id", "store_id", "product_id", "ending_stock", "expected_ending", "stock_status", "expected_status")


def audit_rating(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q9: feedback whose sentiment does not fit its rating."""
    return Q.rating_sentiment(customer_feedback(spark, sf_dir)).select(
        "feedback_id", "rating", "sentiment", "expected_sentiment")


def audit_feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q11: feedback too early or late, by another customer or on a product that the transaction lacks."""
    src = retail_from_tpch(spark, sf_dir)
    found = Q.feedback_violations(customer_feedback(spark, sf_dir), src["sales_transactions"], src["sales_transaction_details"])
    return found.select("feedback_id", "transaction_id", "product_id", "customer_id", "feedback_date", "trx_customer", "trx_date")


STOCK = {f.__name__: f for f in (stock_levels, audit_stock, audit_rating, audit_feedback)}

_STOCK = """
WITH RECURSIVE moves AS (
  SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) % 20 AS product_id, user_id % 5 AS store_id, ts,
         CASE WHEN event_type IN ('view', 'signup') THEN CAST(floor(value) AS BIGINT) ELSE 0 END AS stock_in,
         CASE WHEN event_type IN ('click', 'purchase') THEN CAST(floor(value) AS BIGINT) ELSE 0 END AS stock_out,
         CASE WHEN event_type = 'error' THEN CAST(floor(value) AS BIGINT) END AS counted
  FROM events
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY store_id, product_id ORDER BY ts, event_id) AS i FROM moves
), walked AS (
  SELECT *, CAST(0 AS BIGINT) AS beginning_stock, greatest(0, stock_in - stock_out) AS carried FROM numbered WHERE i = 1
  UNION ALL
  SELECT n.*, w.carried, greatest(0, w.carried + n.stock_in - n.stock_out)
  FROM walked w JOIN numbered n ON n.i = w.i + 1 AND n.store_id = w.store_id AND n.product_id = w.product_id
), recorded AS (
  SELECT event_id AS stock_id, product_id, store_id, CAST(ts AS DATE) AS stock_date, beginning_stock, stock_in, stock_out,
         coalesce(counted, carried) AS ending_stock, carried,
         CASE WHEN carried = 0 THEN 'Out of Stock' WHEN carried < 20 THEN 'Low' ELSE 'Safe' END AS stock_status
  FROM walked
)
"""

_FEEDBACK = """
WITH said AS (
  SELECT event_id, event_type, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(floor(value) AS INTEGER) AS days FROM events
), sold AS (
  SELECT l_orderkey, min(l_partkey) AS sold FROM lineitem GROUP BY 1
), feedback AS (
  SELECT event_id AS feedback_id, event_id AS transaction_id, o_custkey AS trx_customer, CAST(o_orderdate AS DATE) AS trx_date,
         CASE WHEN event_type = 'error' THEN user_id ELSE o_custkey END AS customer_id,
         CASE WHEN k % 10 = 0 THEN k ELSE sold END AS product_id, CAST(o_orderdate AS DATE) + days AS feedback_date,
         days, k % 5 + 1 AS rating, event_type,
         ['Negative', 'Negative', 'Neutral', 'Positive', 'Positive'][CAST(k % 5 + 1 AS INTEGER)] AS expected_sentiment
  FROM said LEFT JOIN orders ON o_orderkey = event_id LEFT JOIN sold ON l_orderkey = event_id
)
"""

STOCK_SQL = {
    "stock_levels": _STOCK + "SELECT * EXCLUDE (carried) FROM recorded",
    "audit_stock": _STOCK + """
SELECT stock_id, store_id, product_id, ending_stock, carried AS expected_ending, stock_status,
       CASE WHEN ending_stock = 0 THEN 'Out of Stock' WHEN ending_stock < 20 THEN 'Low' ELSE 'Safe' END AS expected_status
FROM recorded WHERE ending_stock <> carried OR stock_status <> expected_status""",
    "audit_rating": _FEEDBACK + """
SELECT feedback_id, rating, CASE event_type WHEN 'purchase' THEN 'Positive' WHEN 'view' THEN 'Neutral' ELSE 'Negative' END AS sentiment,
       expected_sentiment
FROM feedback WHERE event_type IN ('purchase', 'view', 'error') AND sentiment <> expected_sentiment""",
    "audit_feedback": _FEEDBACK + """
SELECT feedback_id, transaction_id, product_id, customer_id, feedback_date, trx_customer, trx_date FROM feedback
WHERE trx_date IS NULL OR days NOT BETWEEN 1 AND 14 OR customer_id IS DISTINCT FROM trx_customer
   OR NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = transaction_id AND l_partkey = product_id)""",
}
