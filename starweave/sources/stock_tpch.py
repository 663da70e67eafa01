"""The events of the test data as stock movements and customer feedback.

* inventory_stock: every event moves one product (k of its props, modulo 20)
  of one store (user modulo 5) by the whole part of its value: view and signup
  bring stock in, click and purchase take it out, error is a count that records
  its value as the stock, whatever was carried there
* customer_feedback: every event is feedback on the order of its number, so
  many days later as its value says; the product is the order's smallest, or k
  itself when k is a multiple of ten; the customer is the order's, but the user
  for an error; the rating is k modulo 5, plus 1; purchase, view and error say
  Positive, Neutral and Negative whatever the rating, the others what it means
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import stock_band
from ..operators.stock import running_stock

# Fixed values of the mapping.
STORES, PRODUCTS, RATINGS = 5, 20, 5
INTO, OUT_OF, COUNTED = ("view", "signup"), ("click", "purchase"), "error"
SAID = (("purchase", "Positive"), ("view", "Neutral"), ("error", "Negative"))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("long")
    return spark.read.parquet(f"{sf_dir}/events.parquet").withColumns({"k": k, "whole": F.floor("value").cast("long")})


def inventory_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recorded stock, one row a movement."""
    moves = _events(spark, sf_dir).select(
        F.col("event_id").alias("stock_id"), (F.col("k") % PRODUCTS).alias("product_id"),
        (F.col("user_id") % STORES).alias("store_id"), F.to_date("ts").alias("stock_date"), "ts",
        F.date_trunc("hour", "ts").alias("hour"),
        F.when(F.col("event_type").isin(*INTO), F.col("whole")).otherwise(0).alias("stock_in"),
        F.when(F.col("event_type").isin(*OUT_OF), F.col("whole")).otherwise(0).alias("stock_out"),
        F.when(F.col("event_type") == COUNTED, F.col("whole")).alias("counted"))
    carried = running_stock(moves, ["store_id", "product_id"], "hour", ["ts", "stock_id"])
    return carried.select("stock_id", "product_id", "store_id", "stock_date", "beginning_stock", "stock_in", "stock_out",
                          F.coalesce("counted", "ending_stock").alias("ending_stock"),
                          stock_band(F.col("ending_stock")).alias("stock_status"))


def customer_feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recorded feedback, one row an event."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    first = lines.groupBy(F.col("l_orderkey").alias("order")).agg(F.min("l_partkey").alias("sold"))
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.col("o_orderkey").alias("transaction_id"), "o_custkey", F.to_date("o_orderdate").alias("day"))
    e = _events(spark, sf_dir).withColumn("transaction_id", F.col("event_id")).join(orders, "transaction_id", "left")
    e = e.join(first, F.col("transaction_id") == F.col("order"), "left")
    rating = F.col("k") % RATINGS + 1
    meant = F.when(rating >= 4, "Positive").when(rating == 3, "Neutral").otherwise("Negative")
    said = F.when(F.col("event_type") == SAID[0][0], SAID[0][1])
    for kind, word in SAID[1:]:
        said = said.when(F.col("event_type") == kind, word)
    return e.select(
        F.col("event_id").alias("feedback_id"), "transaction_id",
        F.when(F.col("event_type") == COUNTED, F.col("user_id")).otherwise(F.col("o_custkey")).alias("customer_id"),
        F.when(F.col("k") % 10 == 0, F.col("k")).otherwise(F.col("sold")).alias("product_id"),
        F.expr("date_add(day, int(whole))").alias("feedback_date"), rating.alias("rating"), said.alias("said"), meant.alias("meant"),
    ).withColumn("sentiment", F.coalesce("said", "meant")).drop("said", "meant")
