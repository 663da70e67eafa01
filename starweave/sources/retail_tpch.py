"""The test tables as raw retail tables, so that the real load runs on them.

* sales_transactions = orders: status F is Success, O Cancelled, P Returned;
  the store is the smallest supplier among the order's lines; the priorities
  name payment methods, but '4-NOT SPECIFIED' names none: the load drops those
  lines and the orphan report counts them
* sales_transaction_details = lineitem, prices in whole cents: unit price
  rounded down per piece, so that line arithmetic has violations to find
* products = part, supplied by the smallest supplier that ever delivered it
* promotion_usage = the distinct non-zero discounts of an order, so an order
  with several discounts uses several campaigns
* marketing_campaigns = the distinct non-zero discounts of all lines
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tpch import CAMPAIGN_TYPES, CHANNELS, PART_TYPES, _pick, read_tpch

MONEY = T.DecimalType(15, 2)

# Fixed values of the mapping.
STATUS = (("F", "Success"), ("O", "Cancelled"), ("P", "Returned"))
METHODS = (("1-URGENT", "Cash"), ("2-HIGH", "Debit Card"), ("3-MEDIUM", "Credit Card"), ("5-LOW", "E-Wallet"))
CAMPAIGN_DATES = ("1995-01-01", "2001-12-31")


def _cents(c: str) -> Column:
    return F.round(F.col(c) * 100).cast("long")


def _money(cents: Column) -> Column:
    return (cents.cast("decimal(17,0)") / F.lit(100)).cast(MONEY)


def _map(column: str, pairs) -> Column:
    out = F.when(F.col(column) == pairs[0][0], pairs[0][1])
    for k, v in pairs[1:]:
        out = out.when(F.col(column) == k, v)
    return out.otherwise(F.col(column))


def campaign_id(pct: Column) -> Column:
    return F.format_string("CAM%03d", pct)


def discounted(src: dict[str, DataFrame]) -> DataFrame:
    """(transaction_id, pct) of the lines with a non-zero discount."""
    return src["lineitem"].select(F.col("l_orderkey").alias("transaction_id"), _cents("l_discount").alias("pct")).where("pct > 0")


def discounts(src: dict[str, DataFrame]) -> DataFrame:
    """(transaction_id, pct): the distinct non-zero discounts of each order,
    shuffled by the order alone, so a join by it needs no further shuffle."""
    return discounted(src).repartition("transaction_id").distinct()


def campaigns(pcts: DataFrame, *more: str) -> DataFrame:
    """One campaign for each value of ``pct``, with the columns ``more`` that depend on it."""
    i = ((F.col("pct") - 1) % 4 + 1).cast("int")
    return pcts.select("pct", *more).distinct().select(
        campaign_id(F.col("pct")).alias("campaign_id"), F.format_string("Campaign %d", F.col("pct")).alias("campaign_name"),
        _pick(CAMPAIGN_TYPES, i).alias("campaign_type"), F.lit(CAMPAIGN_DATES[0]).cast("date").alias("start_date"),
        F.lit(CAMPAIGN_DATES[1]).cast("date").alias("end_date"), _pick(CHANNELS, i).alias("channel"),
        F.lit(0).cast(MONEY).alias("campaign_budget"), F.lit("All").alias("target_segment"), *more)


def retail_from_tpch(spark: SparkSession, sf_dir: str, dated: bool = False) -> dict[str, DataFrame]:
    """The raw tables that the load and the audits read.  With ``dated`` the
    transactions carry the day of their last shipment (``shipped``), the usage
    its ``pct`` and whether its order is there (``known``)."""
    src = read_tpch(spark, sf_dir)
    nation, region = src["nation"].select("n_nationkey", "n_name", "n_regionkey"), src["region"]
    places = (src["supplier"].join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
              .join(region.select("r_regionkey", "r_name"), F.col("n_regionkey") == F.col("r_regionkey"), "left"))
    customers = src["customer"].join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"),
        F.when(F.col("c_custkey") % 2 == 0, "Male").otherwise("Female").alias("gender"),
        (18 + F.col("c_custkey") % 43).cast("int").alias("age"), F.col("n_name").alias("city"),
        F.col("c_mktsegment").alias("membership_level"), F.lit(None).cast("date").alias("registration_date"))
    stores = places.select(
        F.col("s_suppkey").alias("store_id"), F.col("s_name").alias("store_name"),
        F.when(F.col("s_suppkey") % 2 == 0, "Mall Store").otherwise("Standalone Store").alias("store_type"),
        F.concat(F.col("n_name"), F.lit("_"), (F.col("s_suppkey") % 3).cast("string")).alias("city"),
        F.col("n_name").alias("province"), F.col("r_name").alias("region"))
    suppliers = places.select(
        F.col("s_suppkey").alias("supplier_id"), F.col("s_name").alias("supplier_name"),
        F.col("n_name").alias("supplier_city"),
        _pick(PART_TYPES, (F.col("s_suppkey") % len(PART_TYPES) + 1).cast("int")).alias("supplier_category"),
        F.lit("Active").alias("supplier_status"))

    li = src["lineitem"]
    source = li.groupBy("l_partkey").agg(F.min("l_suppkey").alias("supplier_id"))
    price = F.col("p_retailprice").cast(MONEY)
    products = src["part"].join(source, F.col("p_partkey") == F.col("l_partkey"), "left").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"), F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"), "supplier_id", price.alias("unit_price"), price.alias("cost_price"),
        F.lit("Active").alias("product_status"))

    seller = li.groupBy("l_orderkey").agg(F.min("l_suppkey").alias("store_id"),
                                          F.max(F.to_date("l_shipdate")).alias("shipped"))
    total = _money(_cents("o_totalprice"))
    transactions = src["orders"].join(seller, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        F.col("o_orderkey").alias("transaction_id"), F.to_date("o_orderdate").alias("transaction_date"), "store_id",
        F.col("o_custkey").alias("customer_id"), _map("o_orderpriority", METHODS).alias("payment_method"),
        total.alias("total_amount"), F.lit(0).cast(MONEY).alias("discount_amount"), total.alias("final_amount"),
        _map("o_orderstatus", STATUS).alias("transaction_status"), *["shipped"] * dated)

    lines = li.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("detail_id"),
        F.col("l_orderkey").alias("transaction_id"), F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"), _cents("l_extendedprice").alias("ext"),
        _cents("l_discount").alias("pct")).withColumn("unit", F.expr("ext div nullif(quantity, 0)"))
    details = lines.select(
        "detail_id", "transaction_id", "product_id", "quantity", _money(F.col("unit")).alias("unit_price"),
        _money(F.expr("unit * pct div 100")).alias("discount_per_item"),
        _money(F.expr("ext - ext * pct div 100")).alias("subtotal"))

    used = discounts(src)
    header = src["orders"].select(F.col("o_orderkey").alias("transaction_id"), F.col("o_custkey").alias("customer_id"),
                                  F.to_date("o_orderdate").alias("usage_date"), F.lit(True).alias("known"))
    usage = used.join(header, "transaction_id", "left").select(
        F.concat_ws("-", F.col("transaction_id").cast("string"), F.col("pct").cast("string")).alias("promo_usage_id"),
        campaign_id(F.col("pct")).alias("campaign_id"), "transaction_id", "customer_id", "usage_date",
        *["pct", "known"] * dated)
    return {"customers": customers, "stores": stores, "suppliers": suppliers, "products": products,
            "sales_transactions": transactions, "sales_transaction_details": details,
            "marketing_campaigns": campaigns(discounted(src)), "promotion_usage": usage}
