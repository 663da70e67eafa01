"""Testdata adapter: derive the retail star from the TPC-H-style tables.

Mapping (SURVEY §7.3), applied identically by the SQL oracle:

* fact grain = lineitem x orders, orders with status 'F' play "Success"
* transaction_id = l_orderkey, detail_id = "l_orderkey-l_linenumber" (not unique)
* product = part, customer = customer (+ nation as city), store = supplier x
  nation x region, supplier = supplier (+ nation), payment method = order
  priority, promotion = discount in cents (0 -> NO_PROMO, 1 -> CAM001, ..)
* money in DECIMAL(15,2): total = extendedprice, discount = total x l_discount,
  final = total - discount, cost = retailprice x quantity, profit = final - cost

Surrogate keys are the integral natural keys themselves (stable across
runs, no global numbering) and ``time_key`` is the yyyymmdd smart key, so
the fact needs lookups only for integrity, not to fetch keys.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.calendar import calendar, calendar_rows, time_key
from ..functions.labels import age_group
from ..plans.star import FACT_PARTITION, Star

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

# Fixed values of the adapter: order priority -> payment type, the part types
# used as supplier categories, campaign types and channels (source ENUMs).
PRIORITY_PAYMENT = (
    ("1-URGENT", "cash"),
    ("2-HIGH", "card"),
    ("3-MEDIUM", "card"),
    ("4-NOT SPECIFIED", "digital"),
    ("5-LOW", "digital"),
)
PART_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
CAMPAIGN_TYPES = ("Discount", "Bundle", "Cashback", "Loyalty")
CHANNELS = ("Store", "Instagram", "Website", "Email")

MONEY = T.DecimalType(15, 2)


@dataclass(frozen=True)
class TpchMapping:
    success_status: str = "F"
    # None: the first and last sale of the data.  Dates given here exclude the
    # sales outside them.
    calendar_start: str | None = None
    calendar_end: str | None = None
    campaign_start: str = "1995-01-01"
    campaign_end: str = "2001-12-31"
    # Drop lines whose customer / supplier is missing (the reference's inner
    # joins).  Each check is one more shuffle at scale; with False the star
    # keeps them and audit Q3 (``star_audits``) reports them instead.
    enforce_fk: bool = True


def read_tpch(spark: SparkSession, sf_dir: str, tables=TABLES) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(f"{sf_dir.rstrip('/')}/{t}.parquet") for t in tables}


def with_calendar(src: dict[str, DataFrame], m: TpchMapping) -> TpchMapping:
    """``m`` with the range of the sale dates where it names none."""
    if m.calendar_start and m.calendar_end:
        return m
    day = F.to_date("o_orderdate")
    lo, hi = src["orders"].where(F.col("o_orderstatus") == m.success_status).agg(F.min(day), F.max(day)).first()
    lo, hi = str(lo or m.campaign_start), str(hi or m.campaign_start)
    return replace(m, calendar_start=m.calendar_start or lo, calendar_end=m.calendar_end or hi)


def _pct(discount: str = "l_discount"):
    """The discount in whole cents; none is 0."""
    return F.round(F.coalesce(F.col(discount), F.lit(0.0)) * 100).cast("int")


def _pick(values, idx_col):
    return F.element_at(F.array(*[F.lit(v) for v in values]), idx_col)


def dimensions(spark: SparkSession, src: dict[str, DataFrame], m: TpchMapping) -> dict[str, DataFrame]:
    nation = src["nation"].select("n_nationkey", "n_name", "n_regionkey")
    region = src["region"].select("r_regionkey", "r_name")

    dim_time = calendar(spark, m.calendar_start, end=m.calendar_end)

    part = src["part"]
    price = F.col("p_retailprice").cast(MONEY)
    dim_product = part.select(
        F.col("p_partkey").alias("product_key"), F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"), F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"), price.alias("unit_price"), price.alias("cost_price"),
        F.lit("Active").alias("product_status"))

    c = src["customer"].join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    age = (F.lit(18) + F.col("c_custkey") % 43).cast("int")
    dim_customer = c.select(
        F.col("c_custkey").alias("customer_key"), F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.when(F.col("c_custkey") % 2 == 0, "Male").otherwise("Female").alias("gender"),
        age.alias("age"), age_group(age).alias("age_group"), F.col("n_name").alias("city"),
        F.col("c_mktsegment").alias("membership_level"),
        F.lit(None).cast("date").alias("registration_date"))

    s = (src["supplier"].join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
         .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left"))
    dim_store = s.select(
        F.col("s_suppkey").alias("store_key"), F.col("s_suppkey").alias("store_id"),
        F.col("s_name").alias("store_name"),
        F.when(F.col("s_suppkey") % 2 == 0, "Mall Store").otherwise("Standalone Store").alias("store_type"),
        F.concat(F.col("n_name"), F.lit("_"), (F.col("s_suppkey") % 3).cast("string")).alias("city"),
        F.col("n_name").alias("province"), F.col("r_name").alias("region"))
    dim_supplier = s.select(
        F.col("s_suppkey").alias("supplier_key"), F.col("s_suppkey").alias("supplier_id"),
        F.col("s_name").alias("supplier_name"), F.col("n_name").alias("supplier_city"),
        _pick(PART_TYPES, (F.col("s_suppkey") % len(PART_TYPES) + 1).cast("int")).alias("supplier_category"),
        F.lit("Active").alias("supplier_status"))

    cid = F.col("id")
    pcts = src["lineitem"].select(_pct().alias("id")).union(spark.range(1).select(F.col("id").cast("int"))).distinct()
    idx = F.pmod(cid - 1, F.lit(4)) + 1
    is_none = cid == 0
    dim_promotion = pcts.select(
        cid.alias("promotion_key"),
        F.when(is_none, "NO_PROMO").otherwise(F.format_string("CAM%03d", cid)).alias("campaign_id"),
        F.when(is_none, "No Promotion").otherwise(F.format_string("Campaign %d", cid)).alias("campaign_name"),
        F.when(is_none, "none").otherwise(_pick(CAMPAIGN_TYPES, idx)).alias("campaign_type"),
        F.when(is_none, "none").otherwise(_pick(CHANNELS, idx)).alias("channel"),
        F.lit("All").alias("target_segment"),
        F.when(is_none, F.lit("2000-01-01")).otherwise(F.lit(m.campaign_start)).cast("date").alias("effective_date"),
        F.when(is_none, F.lit("2099-12-31")).otherwise(F.lit(m.campaign_end)).cast("date").alias("expiry_date"),
        F.lit(True).alias("is_current"))

    dim_payment = spark.createDataFrame(
        [(i + 1, p, t) for i, (p, t) in enumerate(PRIORITY_PAYMENT)],
        "payment_key int, payment_method string, payment_type string")

    return {"time": dim_time, "product": dim_product, "customer": dim_customer, "store": dim_store,
            "supplier": dim_supplier, "promotion": dim_promotion, "payment": dim_payment}


def fact(src: dict[str, DataFrame], dims: dict[str, DataFrame], m: TpchMapping) -> DataFrame:
    """The sales fact.  Filters sit on the scans (status, calendar range);
    the customer integrity check runs on orders, the smaller side; the
    payment map is broadcast."""
    d = F.to_date("o_orderdate")
    orders = (src["orders"]
              .filter((F.col("o_orderstatus") == m.success_status)
                      & d.between(F.lit(m.calendar_start).cast("date"), F.lit(m.calendar_end).cast("date")))
              .select("o_orderkey", "o_custkey", d.alias("sale_date"), "o_orderpriority"))
    if m.enforce_fk:
        orders = orders.join(src["customer"].select(F.col("c_custkey").alias("o_custkey")), "o_custkey", "left_semi")

    li = src["lineitem"].select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                                "l_quantity", "l_extendedprice", "l_discount")
    x = li.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "inner")
    x = x.join(src["part"].select("p_partkey", "p_retailprice"), F.col("l_partkey") == F.col("p_partkey"), "inner")
    if m.enforce_fk:
        x = x.join(src["supplier"].select(F.col("s_suppkey").alias("l_suppkey")), "l_suppkey", "left_semi")
    pay = dims["payment"].select("payment_key", F.col("payment_method").alias("o_orderpriority"))
    x = x.join(F.broadcast(pay), "o_orderpriority", "inner")
    x = x.withColumn("promotion_key", _pct())     # the promotions are the discounts present

    qty = F.col("l_quantity").cast("int")
    total = F.col("l_extendedprice").cast(MONEY)
    disc = F.round(total * F.col("l_discount").cast(T.DecimalType(4, 2)), 2).cast(MONEY)
    cost = (F.col("p_retailprice").cast(MONEY) * qty).cast(MONEY)
    x = x.select(
        time_key(F.col("sale_date")).alias("time_key"),
        F.col("l_partkey").alias("product_key"), F.col("o_custkey").alias("customer_key"),
        F.col("l_suppkey").alias("store_key"), F.col("promotion_key"),
        F.col("l_suppkey").alias("supplier_key"), F.col("payment_key"),
        F.col("l_orderkey").alias("transaction_id"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("detail_id"),
        qty.alias("quantity_sold"),
        F.round(total / F.nullif(qty, F.lit(0)), 2).cast(MONEY).alias("unit_price"),
        disc.alias("discount_amount"), total.alias("total_sales"),
        (total - disc).cast(MONEY).alias("final_sales"), cost.alias("cost_amount"),
        ((total - disc) - cost).cast(MONEY).alias("gross_profit"),
        F.year("sale_date").alias(FACT_PARTITION))
    return x


def star_from_tpch(spark: SparkSession, sf_dir: str, mapping: TpchMapping = TpchMapping()) -> Star:
    """A lazily derived star; only the calendar's range is read at once."""
    src = read_tpch(spark, sf_dir)
    mapping = with_calendar(src, mapping)
    dims = dimensions(spark, src, mapping)
    bounds = {"time": calendar_rows(mapping.calendar_start, end=mapping.calendar_end),
              "payment": len(PRIORITY_PAYMENT)}
    # date, customer and priority come from the order: one value per transaction
    return Star(fact(src, dims, mapping), dims, bounds, trx_level=frozenset({"time", "customer", "payment"}))
